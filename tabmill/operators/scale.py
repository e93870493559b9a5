"""Standardisation fit on one frame and applied to any: (x - mean) / std
with the population std, and 1 in place of a zero std (a constant column
maps to 0, not to a division error)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    mean: dict[str, float]
    std: dict[str, float]


def fit_scaler(df: DataFrame, cols: list[str]) -> Scaler:
    """Mean and population std of every column in one aggregate."""
    exprs = []
    for c in cols:
        x = F.col(c).cast("double")
        exprs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = df.agg(*exprs).collect()[0]
    mean = {c: float(row[f"m_{c}"] or 0.0) for c in cols}
    std = {c: (float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0) for c in cols}
    return Scaler(mean, std)


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(scaler.std[c])
                           for c, m in scaler.mean.items() if c in df.columns})


def standardize(train: DataFrame, others: list[DataFrame], cols: list[str]):
    s = fit_scaler(train, cols)
    return apply_scaler(train, s), [apply_scaler(o, s) for o in others], s
