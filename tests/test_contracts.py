"""Input contracts: missing tables and columns, non-numeric columns,
non-finite cells."""

import pytest

from tabmill.operators import clean
from tabmill.sources.tables import MissingInput, read_table, require_columns, require_numeric


def test_missing_table_names_it(spark, sf_small):
    with pytest.raises(MissingInput, match="no_such_table"):
        read_table(spark, sf_small, "no_such_table")


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    require_columns(df, ["a", "b"])
    with pytest.raises(MissingInput, match="c"):
        require_columns(df, ["a", "c"])


def test_numeric_check(spark):
    df = spark.createDataFrame([(1, "x")], "a int, s string")
    require_numeric(df, ["a"])
    with pytest.raises(TypeError):
        require_numeric(df)


def test_nonfinite_audit(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (float("inf"), None)], "a double, b double")
    rows = {r["column"]: (r["n_null"], r["n_nan"], r["n_inf"]) for r in clean.audit_nonfinite(df).collect()}
    assert rows == {"a": (0, 0, 1), "b": (1, 1, 0)}
    with pytest.raises(ValueError):
        clean.assert_finite(df)
