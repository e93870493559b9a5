"""Hand-written edge tables (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from tabmill.functions.quantiles import column_medians, column_quantiles, kth_smallest
from tabmill.operators import clean, evaluate, select


def test_constant_and_empty_columns_have_no_correlation(spark):
    from tabmill.operators import select
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (4.0, 5.0, None)], "x double, c double, n double")
    assert [r["r"] for r in select.corr_matrix(df, ["x", "c", "n"]).collect()] == [None] * 3
    assert select.corr_drop_list(df, ["x", "c", "n"], 0.8) == []


def test_correlation_is_pairwise_complete_at_any_width(spark):
    """The same pair gives the same value in a table of 3 and of 70 columns, and equals pandas."""
    import numpy as np
    import pandas as pd
    from tabmill.operators import select
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 70))
    x[:, 2] = x[:, 0] * 2 + rng.normal(size=200)
    x[::3, 0], x[1::3, 1] = np.nan, np.nan
    names = [f"c{i}" for i in range(70)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{n} double" for n in names))
    wide = {(r["a"], r["b"]): r["r"] for r in select.corr_matrix(df, names).collect()}
    want = pdf.corr().abs()
    assert len(wide) == 70 * 69 // 2
    assert max(abs(v - want.loc[a, b]) for (a, b), v in wide.items()) < 1e-9
    for r in select.corr_matrix(df, names[:3]).collect():
        assert abs(r["r"] - wide[r["a"], r["b"]]) < 1e-12


def test_preprocess_drops_an_all_null_feature(spark, sf_small):
    from pyspark.sql import functions as F
    from tabmill.plans import pipeline as P
    from tabmill.sources.assay import ASSAY_SPEC
    raw = P.assay_raw(spark, sf_small).withColumn("acctbal", F.lit(None).cast("double"))
    pre = P.preprocess(raw, ASSAY_SPEC)
    assert "acctbal" not in pre.kept and pre.kept


def test_keyed_order_statistics_on_any_key_type(spark):
    """The same answer whether brackets are sorted at once or narrowed, for boolean, large double, NULL beside '' and date keys."""
    import datetime
    from tabmill.functions.quantiles import exact_quantiles
    keys = {"boolean": [True, False, None], "double": [1e7, 0.5, None], "string": ["", None, "x"], "date": [datetime.date(2020, 1, 1), None, datetime.date(1999, 9, 9)]}
    for kind, values in keys.items():
        rows = [(values[i % 3], float((i * 37) % 101)) for i in range(300)]
        df = spark.createDataFrame(rows, f"k {kind}, v double")
        a = exact_quantiles(df, ["k"], "v", [0.25, 0.5])
        b = exact_quantiles(df, ["k"], "v", [0.25, 0.5], max_bracket=1)
        assert a == b and len(a) == 3 and all(x is not None for q in a.values() for x in q.values())


def test_stages_need_a_shared_folder_off_local_masters():
    import pytest
    from tabmill.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_even_count_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert column_medians(df, ["v"])["v"] == 2.5


def test_mode_tie_smallest_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("c", None), (None, None)], "s string, t string")
    out, modes = clean.impute_mode(df, ["s", "t"])
    assert modes.values == {"s": "a", "t": "Unknown"}
    assert sorted(r["s"] for r in out.collect()) == ["a", "a", "b", "c"]


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert clean.dedup_rows(df).count() == 1
    r = clean.dup_count(df).collect()[0]
    assert (r["rows"], r["distinct_rows"], r["duplicates"]) == (2, 1, 1)


def test_tied_scores_auc_and_average_precision(spark):
    rows = [(0, .1), (1, .4), (0, .35), (1, .8), (0, .8), (1, .2)]
    df = spark.createDataFrame(rows, "y int, p double")
    m = evaluate.curve_metrics(df, "y", "p").collect()[0]
    assert round(m["roc_auc"], 4) == 0.6111
    assert round(m["average_precision"], 4) == 0.5889


def test_curves_over_many_ranges_and_a_null_group(spark):
    """Cumulative counts do not depend on how many ranges the scores are dealt to; a NULL group is kept."""
    rows = [(g, float((i * 37) % 211), i % 3 == 0) for g in ("a", None) for i in range(211)]
    df = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g string, score double, y int")
    st = evaluate.score_counts(df, "y", "score", ["g"])
    got = {(r["g"], r["score"]): (r["tp"], r["fp"]) for r in evaluate.cumulative_desc(st, ["g"]).collect()}
    assert len(got) == 422
    for g in ("a", None):
        tp = fp = 0
        for _, s, y in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1]):
            tp, fp = tp + y, fp + (not y)
            assert got[g, s] == (tp, fp)
    assert evaluate.roc_curve(df, "y", "score", ["g"]).count() == 424

def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "y int, yhat int")
    m = evaluate.metrics_classification(df, "y", "yhat").collect()[0]
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_zero_negative_target_floor(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,)], "t double")
    out, counts = clean.floor_positive(df, ["t"])
    assert counts == {"t": 2}
    assert [r["t"] for r in out.collect()] == [1e-6, 1e-6, 2.0]


def test_correlation_chain_drops_later_columns(spark):
    rows = [(float(i), float(i) + (i % 2) * 0.5, float(i) + (i % 3) * 0.9) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert select.corr_drop_list(df, ["a", "b", "c"], 0.8) == ["b", "c"]


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (100.0,), (2.0,), (3.0,)], "v double")
    out, f = clean.clip_iqr(df, ["v"])
    vals = [r["v"] for r in out.collect()]
    assert vals[1] is None and max(v for v in vals if v is not None) == f.upper("v")


@pytest.mark.parametrize("max_bracket", [5, 50, 100000])
def test_exact_quantiles_narrowing_matches_numpy(spark, max_bracket):
    """The bracket narrowing (tiny max_bracket forces several rounds) gives
    the same exact quantiles as sorting, ties and a hot value included."""
    import numpy as np
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=700), np.full(350, 0.25), rng.integers(0, 5, 200)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    qs = column_quantiles(df, ["v"], [0.1, 0.25, 0.5, 0.75, 0.9], max_bracket=max_bracket, accuracy=100)
    for q, got in qs["v"].items():
        want = float(np.quantile(vals, q))
        assert math.isclose(got, want, rel_tol=0, abs_tol=1e-12), (q, got, want)


def test_kth_smallest_grouped(spark):
    rows = [(g, float(v)) for g in ("a", "b") for v in range(100)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = kth_smallest(df, ["g"], "v", {("a",): [0, 57], ("b",): [99]}, max_bracket=10, accuracy=50)
    assert out[("a",)] == {0: 0.0, 57: 57.0} and out[("b",)] == {99: 99.0}


def test_box_of_a_column_without_values(spark):
    from tabmill.operators.chartdata import box_summary
    df = spark.createDataFrame([(1.0, None), (2.0, None), (9.0, None)], "a double, b double")
    rows = {r["feature"]: r for r in box_summary(df, ["a", "b"]).collect()}
    assert rows["a"]["median"] == 2.0
    assert rows["b"].asDict() == {"feature": "b", "q1": None, "median": None, "q3": None, "whisker_lo": None, "whisker_hi": None, "n_fliers": 0}
