"""Feature selection: pairwise absolute Pearson correlation, the
drop-later-of-a-correlated-pair rule, and the population-variance filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTIAL = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_sums(width: int):
    """Per task: for every pair of columns, the sums over the rows in which both are present, from
    Gram matrices of the values (absent: 0) and of the masks."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        n, sx, sxx, sxy = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            here = ~np.isnan(x)
            x[~here] = 0.0
            m = here.astype(np.float64)
            n += m.T @ m
            sx += x.T @ m
            sxx += (x * x).T @ m
            sxy += x.T @ x
        i, j = np.triu_indices(width, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[i, j]), pa.array(sx[i, j]),
             pa.array(sx[j, i]), pa.array(sxx[i, j]), pa.array(sxx[j, i]), pa.array(sxy[i, j])],
            ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])
    return run


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, pos_a, pos_b, r) for every pair pos_a < pos_b, r = |Pearson|.

    Rows with a NULL (or NaN) in either column are skipped pair by pair, as pandas does, at any
    width; a constant column, or one without values, gives r = NULL (undefined), never an error.
    Every task reduces its rows to six sums per pair, so the shuffle carries pairs x tasks rows
    whatever the table's length. Columns are first shifted by their mean and scaled by their
    deviation (correlation does not change), which keeps the sums well conditioned."""
    schema = "a string, b string, pos_a int, pos_b int, r double"
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], schema)
    x = [F.col(c).cast("double") for c in cols]
    x = [F.when(~F.isnan(c), c) for c in x]
    fit = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(x) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).collect()[0]
    scaled = [((c - F.lit(fit[f"m{i}"])) / F.lit(fit[f"s{i}"] or 1.0)).cast("double").alias(f"c{i}") for i, c in enumerate(x)]
    sums = df.select(*scaled).mapInArrow(_pair_sums(len(cols)), _PARTIAL)
    sums = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    # a column without spread has only rounding left of its sums
    flat = (vx <= 1e-12 * n * F.col("sxx")) | (vy <= 1e-12 * n * F.col("syy"))
    r = F.when(~flat, F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(vx) * F.sqrt(vy)))
    names = F.array(*map(F.lit, cols))
    return sums.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), F.col("i").alias("pos_a"),
                       F.col("j").alias("pos_b"), F.when(r.isNotNull(), F.least(F.abs(r), F.lit(1.0))).alias("r"))


def corr_drop(corr: DataFrame, threshold: float) -> DataFrame:
    """Columns b for which some earlier column a has |r| > threshold,
    counting partners that are themselves dropped (no sequential loop)."""
    return (corr.where((F.col("r") > F.lit(threshold)) & ~F.isnan("r"))
            .groupBy("b").agg(F.min("pos_b").alias("position"))
            .select(F.col("b").alias("feature"), "position"))


def corr_drop_list(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    rows = corr_drop(corr_matrix(df, cols), threshold).collect()
    return [r["feature"] for r in sorted(rows, key=lambda r: r["position"])]


def variances(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, position, variance) with population variance."""
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in cols])
    stacks = [F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"),
                       F.col(c).alias("variance")) for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*stacks)).alias("s")).select("s.*")


def variance_keep(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    rows = variances(df, cols).where(F.col("variance") > F.lit(threshold)).collect()
    keep = {r["feature"] for r in rows}
    return [c for c in cols if c in keep]
