"""The assay fixture against a brute-force pandas build of the same columns."""

import os

import pandas as pd

from tabmill.sources.assay import assay


def _lines_by_pandas(sf_dir):
    li = pd.read_parquet(os.path.join(sf_dir, "lineitem.parquet"),
                         columns=["l_orderkey", "l_partkey", "l_extendedprice"])
    g = li.groupby("l_orderkey")
    return pd.DataFrame({
        "n_lines": g.size(),
        "n_parts": g["l_partkey"].nunique(),
        "sum_price_cents": g["l_extendedprice"].apply(lambda s: int((s * 100).round().sum())),
    })


def test_fixture_line_columns_match_pandas(spark, sf_small):
    got = (assay(spark, sf_small).select("id", "n_lines", "n_parts", "sum_price")
           .toPandas().set_index("id"))
    want = _lines_by_pandas(sf_small)
    orders = pd.read_parquet(os.path.join(sf_small, "orders.parquet"), columns=["o_orderkey"])
    assert len(got) == len(orders)
    with_lines = got.loc[got.index.isin(want.index)]
    w = want.loc[with_lines.index]
    assert (with_lines["n_lines"].astype("int64") == w["n_lines"]).all()
    assert (with_lines["n_parts"].astype("int64") == w["n_parts"]).all()
    assert ((with_lines["sum_price"] * 100).round().astype("int64") == w["sum_price_cents"]).all()
    # orders without line items keep NULL line features
    assert got.loc[~got.index.isin(want.index), "n_parts"].isna().all()


def test_fixture_repeated_and_null_parts(spark, tmp_path):
    d = str(tmp_path)
    pd.DataFrame({
        "l_orderkey": [1, 1, 1, 2, 2],
        "l_partkey": pd.array([10, 10, 11, None, None], dtype="Int64"),
        "l_quantity": [1.0, 2.0, 3.0, 4.0, 5.0],
        "l_extendedprice": [10.0, 20.0, 30.0, 40.0, 50.0],
        "l_discount": [0.0, 0.1, 0.0, 0.0, 0.05],
        "l_tax": [0.0, 0.0, 0.02, 0.0, 0.0],
        "l_returnflag": ["R", "N", "A", "R", "N"],
    }).to_parquet(f"{d}/lineitem.parquet")
    pd.DataFrame({"p_partkey": [10, 11], "p_size": pd.array([5, 7], dtype="int32"),
                  "p_retailprice": [1.5, 2.5]}).to_parquet(f"{d}/part.parquet")
    pd.DataFrame({"o_orderkey": [1, 2, 3], "o_custkey": [100, 100, 100],
                  "o_totalprice": [60.0, 90.0, 5.0],
                  "o_orderdate": pd.to_datetime(["1995-01-02"] * 3)}).to_parquet(
        f"{d}/orders.parquet", coerce_timestamps="us")
    pd.DataFrame({"c_custkey": [100], "c_acctbal": [12.5],
                  "c_nationkey": pd.array([3], dtype="int32")}).to_parquet(f"{d}/customer.parquet")
    rows = {r["id"]: r for r in assay(spark, d).select("id", "n_lines", "n_parts").collect()}
    assert (rows[1]["n_lines"], rows[1]["n_parts"]) == (3, 2)   # part 10 twice counts once
    assert (rows[2]["n_lines"], rows[2]["n_parts"]) == (2, 0)   # NULL parts are not counted
    assert rows[3]["n_lines"] is None and rows[3]["n_parts"] is None  # no line items
