"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 60 bits of md5 keep the value inside a signed bigint in Spark and DuckDB.
HASH_HEX_DIGITS = 15
HASH_SPACE = float(16 ** HASH_HEX_DIGITS)


def rnd(c: Column | str, digits: int) -> Column:
    """Round half away from zero on ``x * 10^d``, then divide.

    This is the same arithmetic DuckDB's ``round(double, d)`` performs, so
    rounded doubles agree bit for bit (Spark's own ``round`` rounds the
    decimal text of the value, which differs on binary ties)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    # + 0.0 turns a rounded -0.0 into 0.0, so the sign of zero never differs
    return F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def is_nonfinite(c: Column | str) -> Column:
    """True for NULL, NaN and +-infinity."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast("double")
    return d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def nan_to_null(c: Column | str) -> Column:
    """pandas has one missing marker; Spark has NULL and NaN. NaN compares
    as the largest double in Spark, so it is folded into NULL on load."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def hash_bits(id_col: Column | str, seed: int, salt: str = "") -> Column:
    """Deterministic 60-bit integer of ``(id, seed[, salt])``.

    Depends only on the row's key, never on partitioning, so splits and
    folds are stable under repartition and task retry, and need no
    shuffle. DuckDB computes the same value from ``md5``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    parts = [c.cast("string"), F.lit(str(seed))]
    if salt:
        parts.append(F.lit(salt))
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def hash_uniform(id_col: Column | str, seed: int, salt: str = "") -> Column:
    """``hash_bits`` scaled to [0, 1)."""
    return hash_bits(id_col, seed, salt).cast("double") / F.lit(HASH_SPACE)


def safe_div(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den`` with NULL (or ``default``) where ``den`` is zero or NULL."""
    q = F.try_divide(num, den)
    return q if default is None else F.coalesce(q, F.lit(default))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
