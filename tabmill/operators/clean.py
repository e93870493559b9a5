"""Cleaning: duplicates, renames, IQR clipping, median / mode imputation,
flooring at a small positive value, log1p columns. Fit steps return small
frozen values so the same fitted numbers can be applied to other data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.quantiles import column_medians
from tabmill.operators.profile import Fences, fit_fences, mode_values

# fixed values: floor for non-positive targets, fill for an all-null text column
POSITIVE_FLOOR = 1e-6
UNKNOWN = "Unknown"


# ---- duplicates -----------------------------------------------------------

def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows; NULLs compare equal. The hash aggregate
    combines copies inside each task before the shuffle, so a group of
    copies holding a third of the table costs one row per task."""
    return df.dropDuplicates()


def dup_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and duplicates, from one grouped pass."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return groups.agg(F.coalesce(F.sum("__c"), F.lit(0)).cast("bigint").alias("rows"),
                      F.count(F.lit(1)).cast("bigint").alias("distinct_rows")).select(
        "rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("duplicates"))


# ---- renames and projections ---------------------------------------------

def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the named columns that exist; others pass through."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def feature_names(df: DataFrame, keep: list[str], prefix: str = "feature_") -> dict[str, str]:
    """``feature_<position>`` for every column not in ``keep`` (position in
    the table, so the numbering has gaps where kept columns sit)."""
    return {c: f"{prefix}{i}" for i, c in enumerate(df.columns) if c not in keep}


def rename_features(df: DataFrame, keep: list[str],
                    prefix: str = "feature_") -> tuple[DataFrame, DataFrame]:
    """Rename all non-kept columns by position; also return the map as a
    small (original, new, position) table built from the schema."""
    mapping = feature_names(df, keep, prefix)
    pos = {c: i for i, c in enumerate(df.columns)}
    map_df = df.sparkSession.createDataFrame(
        [(k, v, pos[k]) for k, v in mapping.items()],
        "original string, new string, position int")
    return df.toDF(*[mapping.get(c, c) for c in df.columns]), map_df


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that exist (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def project_features(df: DataFrame, exclude: list[str], keep_last: list[str] | None = None) -> DataFrame:
    """Features by exclusion, in table order, then ``keep_last`` columns."""
    keep_last = keep_last or []
    feats = [c for c in df.columns if c not in exclude and c not in keep_last]
    return df.select(*feats, *keep_last)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def project_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


# ---- clipping -------------------------------------------------------------

def clip_expr(c: str, lo: float, hi: float):
    """Clip to [lo, hi]; NULL stays NULL (least/greatest would skip it)."""
    col = F.col(c)
    return (F.when(col < F.lit(lo), F.lit(lo))
            .when(col > F.lit(hi), F.lit(hi))
            .otherwise(col).cast("double").alias(c))


def apply_clip(df: DataFrame, fences: Fences) -> DataFrame:
    return df.withColumns({c: clip_expr(c, b[2], b[3]) for c, b in fences.bounds.items()
                           if c in df.columns})


def clip_iqr(df: DataFrame, cols: list[str], fences: Fences | None = None) -> tuple[DataFrame, Fences]:
    """Clip each column to its IQR fences (fit here unless given)."""
    fences = fences or fit_fences(df, cols)
    return apply_clip(df, fences), fences


# ---- imputation -----------------------------------------------------------

@dataclass(frozen=True)
class Medians:
    values: dict[str, float | None]


def fit_medians(df: DataFrame, cols: list[str] | None = None) -> Medians:
    """Exact medians (pandas' median: midpoint of the two middle values)."""
    cols = cols if cols is not None else numeric_columns(df)
    return Medians(column_medians(df, cols))


def apply_medians(df: DataFrame, medians: Medians) -> DataFrame:
    """Fill NULLs with the median. Every imputed column becomes double, so
    the output schema does not depend on which columns held NULLs."""
    out = {c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double"))
           for c, m in medians.values.items() if c in df.columns}
    return df.withColumns(out) if out else df


def impute_median(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, Medians]:
    medians = fit_medians(df, cols)
    return apply_medians(df, medians), medians


@dataclass(frozen=True)
class Modes:
    values: dict[str, str]


def fit_modes(df: DataFrame, cols: list[str] | None = None) -> Modes:
    """Most frequent value per text column (smallest on ties), else
    ``Unknown`` for a column with no values."""
    cols = cols if cols is not None else string_columns(df)
    return Modes({c: UNKNOWN if m is None else m for c, m in mode_values(df, cols).items()})


def apply_modes(df: DataFrame, modes: Modes) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in modes.values.items()
                           if c in df.columns}) if modes.values else df


def impute_mode(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, Modes]:
    modes = fit_modes(df, cols)
    return apply_modes(df, modes), modes


# ---- positive floor and logs ---------------------------------------------

def floor_positive(df: DataFrame, cols: list[str],
                   floor: float = POSITIVE_FLOOR) -> tuple[DataFrame, dict[str, int]]:
    """Count values <= 0 per column (one aggregate); where any exist, raise
    every value below ``floor`` to ``floor``. Columns without such values
    are untouched."""
    row = df.agg(*[F.count_if(F.col(c) <= 0).alias(c) for c in cols]).collect()[0]
    counts = {c: int(row[c]) for c in cols}
    fix = {c: F.when(F.col(c) < F.lit(floor), F.lit(floor)).otherwise(F.col(c)).cast("double")
           for c in cols if counts[c] > 0}
    return (df.withColumns(fix) if fix else df), counts


def log_targets(df: DataFrame, cols: list[str], prefix: str = "log_") -> DataFrame:
    """Append ln(1 + x) columns side by side (a projection, never a join)."""
    return df.withColumns({f"{prefix}{c}": F.log1p(F.col(c)) for c in cols})


def audit_nonfinite(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null, n_nan, n_inf) from one aggregate over all columns."""
    cols = cols if cols is not None else df.columns
    exprs = []
    for c in cols:
        col = F.col(c)
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        d = col.cast("double")
        exprs += [F.count_if(col.isNull()).alias(f"{c}__null"),
                  (F.count_if(F.isnan(d)) if numeric else F.lit(0).cast("bigint")).alias(f"{c}__nan"),
                  (F.count_if(F.abs(d) == F.lit(float("inf"))) if numeric
                   else F.lit(0).cast("bigint")).alias(f"{c}__inf")]
    row = df.agg(*exprs)
    stacks = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__null").alias("n_null"),
                       F.col(f"{c}__nan").alias("n_nan"), F.col(f"{c}__inf").alias("n_inf"))
              for c in cols]
    return row.select(F.explode(F.array(*stacks)).alias("s")).select("s.*")


def assert_finite(df: DataFrame, cols: list[str] | None = None) -> None:
    """Raise when any cell is NULL, NaN or infinite (one aggregate)."""
    bad = audit_nonfinite(df, cols).where("n_null + n_nan + n_inf > 0").collect()
    if bad:
        raise ValueError(f"non-finite values in {[r['column'] for r in bad]}")
