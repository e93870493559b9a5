"""Profiling: shape, missing cells, dtype counts, descriptive statistics,
IQR outlier counts, value counts, and the two-stage comparison tables."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.exprs import rnd
from tabmill.functions.quantiles import column_quantiles

QUARTILES = [0.25, 0.5, 0.75]
IQR_FACTOR = 1.5  # fixed value: Tukey fences at Q1 - 1.5 IQR and Q3 + 1.5 IQR


@dataclass(frozen=True)
class Fences:
    """Fitted IQR fences per column: {col: (q1, q3, lower, upper)}."""
    bounds: dict[str, tuple[float, float, float, float]]

    def lower(self, c: str) -> float:
        return self.bounds[c][2]

    def upper(self, c: str) -> float:
        return self.bounds[c][3]


def fit_fences(df: DataFrame, cols: list[str], factor: float = IQR_FACTOR, **kw) -> Fences:
    """Exact quartiles of every column in one pass family, then fences."""
    qs = column_quantiles(df, cols, [0.25, 0.75], **kw)
    out = {}
    for c in cols:
        q1, q3 = qs[c][0.25], qs[c][0.75]
        if q1 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - factor * iqr, q3 + factor * iqr)
    return Fences(out)


def outlier_exprs(fences: Fences, cols: list[str]) -> list:
    """Strict outside-the-fence counts; NULL never counts."""
    exprs = []
    for c in cols:
        if c not in fences.bounds:
            exprs.append(F.lit(0).cast("bigint").alias(c))
            continue
        lo, hi = fences.lower(c), fences.upper(c)
        exprs.append(F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(c))
    return exprs


def outlier_counts(df: DataFrame, cols: list[str], fences: Fences | None = None) -> DataFrame:
    """(feature, n_outliers, lower, upper) for each column."""
    fences = fences or fit_fences(df, cols)
    counts = df.agg(*outlier_exprs(fences, cols))
    long = counts.unpivot([], cols, "feature", "n_outliers")
    spark = df.sparkSession
    bounds = spark.createDataFrame(
        [(c, *fences.bounds.get(c, (None,) * 4)[2:]) for c in cols],
        "feature string, lower double, upper double")
    return long.join(F.broadcast(bounds), "feature").select(
        "feature", F.col("n_outliers").cast("bigint").alias("n_outliers"),
        rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"))


def dtype_counts(df: DataFrame) -> dict[str, int]:
    """Columns per type, from the schema alone (no job)."""
    return dict(Counter(f.dataType.simpleString() for f in df.schema.fields))


def profile_info(df: DataFrame, stage: str, outlier_cols: list[str],
                 dtypes: list[str] | None = None, fences: Fences | None = None) -> DataFrame:
    """One row: stage, rows, columns, missing cells, columns per type and
    outliers per given column. Rows, missing cells and outliers come from
    one aggregate (after one quartile fit, skipped when ``fences`` already
    fitted on this same table are given)."""
    cols = [c for c in outlier_cols if c in df.columns]
    if fences is None or any(c not in fences.bounds for c in cols):
        fences = fit_fences(df, cols) if cols else Fences({})
    missing = [F.sum(F.col(c).isNull().cast("bigint")) for c in df.columns]
    total_missing = missing[0]
    for m in missing[1:]:
        total_missing = total_missing + m
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(total_missing, F.lit(0)).cast("bigint").alias("missing_values"),
                 *[e.alias(f"outliers_{c}") for e, c in zip(outlier_exprs(fences, cols), cols)])
    counts = dtype_counts(df)
    dtypes = dtypes if dtypes is not None else sorted(counts)
    return agg.select(
        F.lit(stage).alias("stage"), "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        "missing_values",
        *[F.lit(counts.get(t, 0)).cast("bigint").alias(f"dtype_{t}") for t in dtypes],
        *[F.col(f"outliers_{c}").cast("bigint") for c in cols])


def describe_table(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per numeric column,
    rounded. The wide table is unpivoted to (feature, v) once, so the
    statistics are one grouped aggregate whatever the width."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "v")
    stats = long.groupBy("feature").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    qs = column_quantiles(df, cols, QUARTILES)
    qdf = df.sparkSession.createDataFrame(
        [(c, qs[c][0.25], qs[c][0.5], qs[c][0.75]) for c in cols],
        "feature string, q25 double, q50 double, q75 double")
    return stats.join(F.broadcast(qdf), "feature").select(
        "feature", F.col("count").cast("bigint").alias("count"),
        *[rnd(c, digits).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def profile_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two-stage info table; a column one stage lacks is NULL there."""
    return before.unionByName(after, allowMissingColumns=True)


def profile_compare_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two-stage long statistics table (describe_table outputs)."""
    return (before.withColumn("stage", F.lit("before"))
            .unionByName(after.withColumn("stage", F.lit("after"))))


def quantiles_table(df: DataFrame, cols: list[str], probs: list[float],
                    digits: int = 4) -> DataFrame:
    """(feature, q, value) exact quantiles."""
    qs = column_quantiles(df, cols, probs)
    rows = [(c, float(p), qs[c][p]) for c in cols for p in probs]
    out = df.sparkSession.createDataFrame(rows, "feature string, q double, value double")
    return out.select("feature", "q", rnd("value", digits).alias("value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share) over all rows, as pandas' normalised value counts.
    The total is one count on the driver, so no window over all groups."""
    total = df.count()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .select(col, "n", (F.col("n") / F.lit(float(max(total, 1)))).alias("share")))


def mode_values(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent non-null value of each column, smallest on ties, or None: one job for any number of text columns.

    Counted by (column, value) with partial aggregation per task, so a hot value costs one row per task and column; the
    best of each column is one more aggregate with partial results."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])
    counts = (df.select(F.explode(pairs).alias("s")).select("s.*").where(F.col("v").isNotNull())
              .groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v")).collect()
    found = {r["feature"]: r["v"] for r in best}
    return {c: found.get(c) for c in cols}


def mode_value(df: DataFrame, col: str):
    """Most frequent non-null value, smallest on ties, or None.

    Counted by ``groupBy(value)`` (partial aggregation per task, so a hot
    value costs one row per task), then the top row by (count desc, value)
    is a bounded top-1."""
    row = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc(col)).limit(1).collect())
    return row[0][col] if row else None
