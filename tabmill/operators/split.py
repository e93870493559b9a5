"""Holdout splits and fold assignment from a hash of the row key.

A row's side depends only on (id, seed), never on partitioning, so the
split needs no shuffle, is stable under repartition and task retry, and
DuckDB reproduces it from md5. The stratified split takes, per class, the
round(frac * n_class) rows with the smallest hash; the cut value per class
is an exact order statistic found without sorting the class in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.exprs import hash_uniform
from tabmill.functions.quantiles import group_sizes, kth_smallest
from tabmill.session import materialize

SEED = 42          # fixed value: the seed the reference uses for splits and models
TEST_FRACTION = 0.2
N_FOLDS = 5


def split_random(df: DataFrame, id_col: str, test_frac: float = TEST_FRACTION,
                 seed: int = SEED, out: str = "split") -> DataFrame:
    u = hash_uniform(id_col, seed)
    return df.withColumn(out, F.when(u < F.lit(test_frac), "test").otherwise("train"))


def stratified_cuts(df: DataFrame, id_col: str, label: str, test_frac: float,
                    seed: int) -> dict:
    """Per class: the largest hash that still goes to test (None: no test)."""
    h = materialize(df.select(label, hash_uniform(id_col, seed).alias("__u")), "hashes")  # md5 once, not in every pass
    sizes = group_sizes(h, [label], "__u")
    ranks = {}
    for g, n in sizes.items():
        t = int(math.floor(test_frac * n + 0.5))
        if t > 0:
            ranks[g] = [t - 1]
    kth = kth_smallest(h, [label], "__u", ranks, sizes=sizes)
    return {g[0]: kth[g][ks[0]] for g, ks in ranks.items()}


def split_stratified(df: DataFrame, id_col: str, label: str,
                     test_frac: float = TEST_FRACTION, seed: int = SEED,
                     out: str = "split") -> DataFrame:
    cuts = stratified_cuts(df, id_col, label, test_frac, seed)
    u = hash_uniform(id_col, seed)
    cond = F.lit(False)
    for cls, tau in cuts.items():
        cond = cond | (F.col(label).eqNullSafe(F.lit(cls)) & (u <= F.lit(tau)))
    return df.withColumn(out, F.when(cond, "test").otherwise("train"))


def kfold_assign(df: DataFrame, id_col: str, k: int = N_FOLDS, seed: int = SEED,
                 out: str = "fold", label: str | None = None) -> DataFrame:
    """fold = floor(k * u) with a hash salted apart from the holdout's. With ``label`` the folds are stratified: within
    every class the rows in hash order are cut into k parts whose sizes differ by one at most; the cuts are exact
    order statistics."""
    u = hash_uniform(id_col, seed, "fold")
    if label is None:
        return df.withColumn(out, F.floor(u * F.lit(float(k))).cast("int"))
    h = materialize(df.select(label, u.alias("__u")), "hashes")
    sizes = group_sizes(h, [label], "__u")
    ranks = {g: sorted({n * f // k - 1 for f in range(1, k)} - {-1}) for g, n in sizes.items()}
    kth = kth_smallest(h, [label], "__u", ranks, sizes=sizes)
    fold = F.lit(0)
    for g, n in sizes.items():
        cuts = [kth[g][n * f // k - 1] if n * f // k else -1.0 for f in range(1, k)]
        after = sum((u > F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
        fold = F.when(F.col(label).eqNullSafe(F.lit(g[0])), after).otherwise(fold)
    return df.withColumn(out, fold.cast("int"))
