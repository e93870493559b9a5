"""Reading and writing tables, and the contracts checked before a step runs
(required columns, all-numeric)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tabmill.functions.exprs import nan_to_null


class MissingInput(RuntimeError):
    """An input table or column a step needs is absent."""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one Parquet table; a missing file names the table."""
    try:
        return spark.read.parquet(table_path(sf_dir, name))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # e.g. an unreadable column type
            raise
        raise MissingInput(f"input table {name!r} not found under {sf_dir}") from e


def normalise_missing(df: DataFrame) -> DataFrame:
    """Fold NaN into NULL in every floating column (one marker, as pandas)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(nan_to_null(f.name).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Load a raw or processed wide table from Parquet or CSV.

    CSV gets an explicit schema when one is given (no inference pass over
    the data), else the header row and inferred types."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "csv":
            df = reader.option("header", header).option(
                "inferSchema", schema is None).csv(path)
        else:
            df = reader.format(fmt).load(path)
    except AnalysisException as e:
        raise MissingInput(f"cannot read {path}: {e}") from e
    return normalise_missing(df)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Write with header (CSV) and no index, replacing what is there."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def require_columns(df: DataFrame, required: list[str], what: str = "table") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingInput(f"{what} lacks required columns {missing}")


def require_numeric(df: DataFrame, cols: list[str] | None = None) -> None:
    cols = cols if cols is not None else df.columns
    bad = [c for c in cols if not isinstance(df.schema[c].dataType, T.NumericType)]
    if bad:
        raise TypeError(f"non-numeric columns: {bad}")
