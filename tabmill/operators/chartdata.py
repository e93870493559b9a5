"""The tables behind the study's figures: histogram bins, a Gaussian
density curve, box summaries with outlier points, and predicted-against-true
pairs. Each is a few aggregates; nothing is drawn."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.exprs import hash_uniform
from tabmill.functions.quantiles import column_quantiles
from tabmill.operators.profile import IQR_FACTOR


#: Density sums: cells of half a bandwidth, ten moments a cell, kernels cut at eight bandwidths.
KDE_CELLS, KDE_MOMENTS, KDE_REACH = 2.0, 10, 8.0


def _spans(df: DataFrame, cols: list[str], *more) -> dict:
    """Per column: minimum, maximum and ``more`` of its values, from one aggregate over all columns."""
    made = [F.min, F.max, *more]
    row = df.agg(*[f(F.col(c)).alias(f"{i}_{k}") for i, c in enumerate(cols) for k, f in enumerate(made)]).collect()[0]
    return {c: [row[f"{i}_{k}"] for k in range(len(made))] for i, c in enumerate(cols)}


def histograms(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """(feature, bin, lo, hi, n) for every bin of every column, empty ones included; a maximum falls in its column's last
    bin. Columns without values have no bins. All columns are counted in one scan."""
    edges, cells = [], []
    for c, (lo, hi) in _spans(df, cols).items():
        if lo is None:
            continue
        width = (hi - lo) if hi > lo else 1.0
        lo, width = (F.lit(x).cast("double") for x in (lo, width))
        b = F.least(F.floor((F.col(c) - lo) / width * F.lit(float(bins))) + 1, F.lit(bins)).cast("int")
        cells.append(F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), b).alias("bin")))  # least() skips nulls
        edges.append(F.struct(F.lit(c).alias("feature"), lo.alias("lo"), width.alias("width")))
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, bin int, lo double, hi double, n long")
    counts = (df.select(F.explode(F.array(*cells)).alias("s")).select("s.*").where(F.col("bin").isNotNull())
              .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), F.explode(F.array(*edges)).alias("e")).select(
        F.col("e.feature").alias("feature"), "bin",
        (F.col("e.lo") + (F.col("bin") - 1) * F.col("e.width") / F.lit(float(bins))).alias("lo"),
        (F.col("e.lo") + F.col("bin") * F.col("e.width") / F.lit(float(bins))).alias("hi"))
    # bins x columns rows on both sides: a bounded broadcast
    return grid.join(F.broadcast(counts), ["feature", "bin"], "left").select(
        "feature", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """(bin, lo, hi, n): ``histograms`` of one column."""
    return histograms(df, [col], bins).drop("feature")


def _hermite(n: int) -> list[int]:
    """Coefficients of the n-th (physicists') Hermite polynomial, constant first."""
    before, now = [0], [1]
    for k in range(n):
        up = [0, *(2 * a for a in now)]
        for i, a in enumerate(before):
            up[i] -= 2 * k * a
        before, now = now, up
    return now


def _power(x, n: int):
    if n == 0:
        return F.lit(1.0)
    half = _power(x, n // 2) if n > 1 else None
    return x if n == 1 else half * half * x if n % 2 else half * half


def densities(df: DataFrame, cols: list[str], grid: int = 100, cut: float = 3.0) -> DataFrame:
    """(feature, x, density) of every column on its own even grid from min - cut*h to max + cut*h, with Scott's bandwidth
    h = std * n^(-1/5). Columns with fewer than two different values have no rows.

    A fast Gauss transform in place of ``grid`` exponentials a row: values fall in cells of h / 2, each cell keeps the sums
    of the first ten powers of the distance to its centre (one scan, partial sums per task), and a grid point adds the
    Hermite expansions of the cells within 8 h. For a value at most h / 4 from its centre the terms left out are below
    1.09 * sum over n >= 10 of 0.25^n / sqrt(n!), so a density is off by less than 6e-10 of a kernel's height
    1 / (h sqrt(2 pi)). A column has about 2 (max - min) / h cells, which grows with n^(1/5) only."""
    stats = _spans(df, cols, F.count, F.stddev_samp)
    cells, grids = [], []
    for c, (lo, hi, n, s) in stats.items():
        if not n or not s:
            continue
        h = s * n ** (-0.2)
        at = (F.col(c).cast("double") - F.lit(float(lo))) / F.lit(h)
        cell = F.floor(at * F.lit(KDE_CELLS))
        off = (at - (cell + 0.5) / F.lit(KDE_CELLS)) / F.lit(math.sqrt(2.0))
        cells.append(F.struct(F.lit(c).alias("feature"), cell.alias("cell"), off.alias("off")))
        start, stop = lo - cut * h, hi + cut * h
        grids.append((c, float(lo), h, float(start), (stop - start) / (grid - 1), float(n) * h * math.sqrt(2 * math.pi)))
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, x double, density double")
    off = F.col("off")
    sums = (df.select(F.explode(F.array(*cells)).alias("s")).select("s.*").where(off.isNotNull()).groupBy("feature", "cell")
            .agg(*[F.sum(_power(off, k)).alias(f"m{k}") for k in range(KDE_MOMENTS)]))
    of = F.create_map(*[v for g in grids for v in (F.lit(g[0]), F.struct(*[
        F.lit(x).alias(k) for k, x in zip(("lo", "h", "start", "step", "norm"), g[1:], strict=True)]))])
    g = F.col("g")
    centre = g["lo"] + (F.col("cell") + 0.5) / F.lit(KDE_CELLS) * g["h"]
    first = F.greatest(F.ceil((F.col("centre") - g["start"] - KDE_REACH * g["h"]) / g["step"]), F.lit(0))
    last = F.least(F.floor((F.col("centre") - g["start"] + KDE_REACH * g["h"]) / g["step"]), F.lit(grid - 1))
    near = (sums.withColumn("g", of[F.col("feature")]).withColumn("centre", centre).where(first <= last)
            .withColumn("i", F.explode(F.sequence(first, last)))
            .withColumn("x", g["start"] + F.col("i") * g["step"])
            .withColumn("t", (F.col("x") - F.col("centre")) / (g["h"] * F.lit(math.sqrt(2.0)))))
    t = F.col("t")
    value = F.lit(0.0)
    for k in range(KDE_MOMENTS):
        poly = F.lit(0.0)
        for a in reversed(_hermite(k)):
            poly = poly * t + F.lit(float(a))
        value = value + poly * F.col(f"m{k}") / F.lit(float(math.factorial(k)))
    added = near.groupBy("feature", "i").agg(F.sum(F.exp(-t * t) * value).alias("v"))
    points = df.sparkSession.range(grid).select(
        F.explode(F.array(*[F.lit(g[0]) for g in grids])).alias("feature"), F.col("id").alias("i"))
    # grid x columns rows on both sides; points out of every kernel's reach have density 0
    both = points.join(F.broadcast(added), ["feature", "i"], "left").withColumn("g", of[F.col("feature")])
    return both.select("feature", (g["start"] + F.col("i") * g["step"]).alias("x"),
                       (F.greatest(F.coalesce("v", F.lit(0.0)), F.lit(0.0)) / g["norm"]).alias("density"))


def kde(df: DataFrame, col: str, grid: int = 100, cut: float = 3.0) -> DataFrame:
    """(x, density): ``densities`` of one column."""
    return densities(df, [col], grid, cut).drop("feature")


def box_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, q1, median, q3, whisker_lo, whisker_hi, n_fliers): whiskers
    at the last values inside the 1.5 IQR fences. A column without values
    has nulls and no fliers."""
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    exprs, rows = [], []
    for c in cols:
        q1, q2, q3 = qs[c][0.25], qs[c][0.5], qs[c][0.75]
        lo, hi = (None, None) if q1 is None else (q1 - IQR_FACTOR * (q3 - q1), q3 + IQR_FACTOR * (q3 - q1))
        v = F.col(c)
        exprs += [F.min(F.when(v >= F.lit(lo).cast("double"), v)).alias(f"{c}__wl"),
                  F.max(F.when(v <= F.lit(hi).cast("double"), v)).alias(f"{c}__wh"),
                  F.count_if((v < F.lit(lo).cast("double")) | (v > F.lit(hi).cast("double"))).alias(f"{c}__nf")]
        rows.append((c, q1, q2, q3))
    agg = df.agg(*exprs)
    stacks = [F.struct(F.lit(c).alias("feature"), F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
                       F.lit(q3).cast("double").alias("q3"), F.col(f"{c}__wl").alias("whisker_lo"),
                       F.col(f"{c}__wh").alias("whisker_hi"), F.col(f"{c}__nf").alias("n_fliers"))
              for c, q1, q2, q3 in rows]
    return agg.select(F.explode(F.array(*stacks)).alias("s")).select("s.*")


def box_fliers(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """(id, feature, value) for every point outside its fences."""
    qs = column_quantiles(df, cols, [0.25, 0.75])
    long = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [id_col], cols, "feature", "value")
    cond = F.lit(False)
    for c in cols:
        q1, q3 = qs[c][0.25], qs[c][0.75]
        lo, hi = (None, None) if q1 is None else (q1 - IQR_FACTOR * (q3 - q1), q3 + IQR_FACTOR * (q3 - q1))
        cond = cond | ((F.col("feature") == c) & ((F.col("value") < lo) | (F.col("value") > hi)))
    return long.where(cond)


def scatter_points(df: DataFrame, id_col: str, y: str, p: str) -> DataFrame:
    """(id, y, p) pairs for a predicted-against-true plot: every row."""
    return df.select(id_col, F.col(y).alias("y"), F.col(p).alias("p"))


def identity_range(df: DataFrame, y: str, p: str) -> DataFrame:
    """(lo, hi): the span of the y = p reference line."""
    return df.agg(F.least(F.min(y), F.min(p)).alias("lo"), F.greatest(F.max(y), F.max(p)).alias("hi"))
