"""Binary labels from a target: against its exact median (>= or >), or
against a fixed threshold given on a stated scale."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.quantiles import column_medians
from tabmill.operators.profile import value_counts


def fit_median(df: DataFrame, col: str) -> float:
    m = column_medians(df, [col])[col]
    if m is None:
        raise ValueError(f"{col} has no values")
    return m


def label_median(df: DataFrame, col: str, out: str, strict: bool = False,
                 median: float | None = None) -> tuple[DataFrame, float]:
    """``out = 1`` where ``col >= median`` (``>`` when ``strict``)."""
    m = fit_median(df, col) if median is None else median
    c = F.col(col)
    cond = (c > F.lit(m)) if strict else (c >= F.lit(m))
    return df.withColumn(out, cond.cast("int")), m


def threshold_value(value: float, scale: str) -> float:
    """The cut on the column's own scale. ``log10`` reproduces comparing a
    log1p column with log10(value); ``log1p`` compares like with like."""
    if scale == "raw":
        return value
    if scale == "log10":
        return math.log10(value)
    if scale == "log1p":
        return math.log1p(value)
    raise ValueError(f"unknown scale {scale!r}")


def label_threshold(df: DataFrame, col: str, out: str, value: float,
                    scale: str = "raw") -> DataFrame:
    return df.withColumn(out, (F.col(col) >= F.lit(threshold_value(value, scale))).cast("int"))


def check_two_classes(df: DataFrame, label: str) -> dict:
    """Class counts; fewer than two classes is an error."""
    rows = df.groupBy(label).count().collect()
    counts = {r[label]: int(r["count"]) for r in rows if r[label] is not None}
    if len(counts) < 2:
        raise ValueError(f"label {label} has fewer than two classes: {counts}")
    return counts


def class_balance(df: DataFrame, label: str, max_gap: float = 0.1,
                  min_minority: int = 5) -> DataFrame:
    """(label, n, share, imbalanced, resample): shares of each class, whether
    the share gap exceeds ``max_gap``, and whether resampling would run
    (imbalanced and the minority has at least ``min_minority`` rows)."""
    vc = value_counts(df, label)
    stats = vc.agg(F.max("share").alias("hi"), F.min("share").alias("lo"),
                   F.min("n").alias("minority"), F.count(F.lit(1)).alias("k")).collect()[0]
    gap = (stats["hi"] - stats["lo"]) if stats["k"] >= 2 else stats["hi"]
    imbalanced = bool(gap is not None and gap > max_gap)
    minority = stats["minority"] if stats["k"] >= 2 else 0
    return vc.select(label, "n", "share", F.lit(imbalanced).alias("imbalanced"),
                     F.lit(imbalanced and minority >= min_minority).alias("resample"))
