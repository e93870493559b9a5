"""Rows-only model keys: invariants instead of an oracle."""

from pyspark.sql import functions as F

import __spark_entry__ as E


def test_predictions_finite_one_per_test_row(spark, sf_small):
    q = E.queries()
    p = q["fit_rf_reg"](spark, sf_small)
    n = p.count()
    assert n > 0 and p.select("id").distinct().count() == n
    assert p.where(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0


def test_vote_is_member_mean(spark, sf_small):
    from tabmill.plans import models as M
    rows = [(i, float(i % 13), float((i * 7) % 5), float(i % 13) * 2.0 + 1.0) for i in range(1, 301)]
    df = M.assemble(spark.createDataFrame(rows, "id long, a double, b double, y double"), ["a", "b"])
    v = M.predict_vote(M.fit_vote(df, "regression", params=M.LIGHT), df, "regression")
    bad = v.where(F.abs(F.col("p") - (F.col("p_rf") + F.col("p_xgb") + F.col("p_lgb") + F.col("p_gb")) / 4) > 1e-9)
    assert bad.count() == 0


def test_importances_sum_to_one(spark, sf_small):
    imp = E.queries()["feature_importance"](spark, sf_small).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-6 or len(imp) == 10
    assert [r["rank"] for r in imp] == list(range(1, len(imp) + 1))


def test_linear_fit_matches_sql_definition(spark, sf_small):
    import duckdb
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "part", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    slope, intercept = con.execute("SELECT slope, intercept FROM (" + E.oracle_sql()["fit_linear"] + ")").fetchone()
    r = E.queries()["fit_linear"](spark, sf_small).collect()[0]
    assert abs(r["slope"] - slope) < 1e-6 and abs(r["intercept"] - intercept) < 1e-6


def test_classifier_probabilities_in_unit_interval(spark, sf_small):
    p = E.queries()["fit_logistic"](spark, sf_small)
    assert p.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def _folded(spark, k=3):
    from pyspark.ml.feature import VectorAssembler
    from tabmill.operators import split
    rows = [(i, float(i % 13), float((i * 7) % 5), float(i % 13) * 2.0 + 1.0) for i in range(1, 301)]
    df = split.kfold_assign(spark.createDataFrame(rows, "id long, a double, b double, y double"), "id", k)
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    return df, [(df.where(F.col("fold") != f), df.where(F.col("fold") == f)) for f in range(k)]


def test_failing_draw_scores_worst(spark):
    """A draw Spark rejects (depth above its cap) scores as the worst value, its trial says why,
    and the search goes on with the others."""
    import math
    from tabmill.plans import tune as TU
    df, folds = _folded(spark)
    draws = [{"numTrees": 3, "maxDepth": 31}, {"numTrees": 3, "maxDepth": 3}]
    model, best, trials = TU.tune(df, "RF", "regression", draws, folds, "mse", 300, parallelism=2)
    assert best == draws[1]
    assert math.isinf(trials[0][2]) and math.isfinite(trials[1][2])
    assert "error" in trials[0][1] and "error" not in trials[1][1]


def test_holdout_is_one_pair(spark):
    from tabmill.plans import tune as TU
    df, folds = _folded(spark)
    draws = TU.search_space(TU.space_for("RF", "regression", light=True), 3)
    model, best, trials = TU.tune(df, "RF", "regression", draws, folds[:1], "mse", 300)
    assert best in draws and len(trials) == 3 and model is not None


def test_linear_space_is_listed():
    from tabmill.plans import tune as TU
    assert TU.draws_for("LR", "regression", False, 50) == [{"fitIntercept": True}, {"fitIntercept": False}]
    assert len(TU.draws_for("LR", "classification", True, 20)) == 20


def test_resampling_stays_inside_the_fold(spark):
    """The synthetic rows of a fold's fit part come from its own rows, and the validation part has none."""
    from tabmill.operators import balance, split
    rows = [(i, float(i % 17), float(i % 5), 1.0 if i % 6 == 0 else 0.0) for i in range(1, 241)]
    df = split.kfold_assign(spark.createDataFrame(rows, "id long, a double, b double, y double"), "id", 3, label="y")
    for f in range(3):
        fit = df.where(F.col("fold") != f)
        syn, nbrs = balance.smote(fit.drop("fold"), "id", ["a", "b"], "y", k=3)
        own = {r["id"] for r in fit.collect()}
        assert {r["source_id"] for r in syn.collect()} <= own
        assert {r["neighbor_id"] for r in syn.collect()} <= own


def test_stratified_folds(spark):
    from tabmill.operators import split
    rows = [(i, i % 4 == 0) for i in range(103)]
    df = split.kfold_assign(spark.createDataFrame(rows, "id long, y boolean"), "id", 5, label="y")
    for y in (True, False):
        sizes = [r["count"] for r in df.where(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_one_model_and_the_vote_failing(spark, sf_small, monkeypatch):
    """A model with an infinite prediction is dropped and says so; a failing vote and a failing model leave the rest."""
    from tabmill.plans import models as M
    from tabmill.plans import pipeline as P
    from tabmill.plans import study
    from tabmill.plans.tasks import TASK_BY_NAME
    from tabmill.sources.assay import ASSAY_SPEC
    pre = P.preprocess(P.assay_raw(spark, sf_small), ASSAY_SPEC)
    build, predict = M.build, M.predict

    def broken(name, *a, **k):
        if name == "GB":
            raise ValueError("no such model")
        return build(name, *a, **k)

    def infinite(model, df, kind, suffix=""):
        out = predict(model, df, kind, suffix)
        if "RandomForest" in type(model).__name__:
            out = out.withColumn("p", F.when(F.col("id") % 7 == 0, float("inf")).otherwise(F.col("p")))
        return out

    monkeypatch.setattr(M, "build", broken)
    monkeypatch.setattr("tabmill.plans.tune.build", broken)
    monkeypatch.setattr(M, "predict", infinite)
    run = study.run_task(pre, TASK_BY_NAME["regression_log_ic50"], n_draws=1, n_folds=2, light=True, models=["RF", "GB", "LR"])
    got = {r["model"]: r for r in run.results.collect()}
    assert got["RF"]["status"].startswith("dropped") and got["RF"]["mse"] is None
    assert got["GB"]["status"].startswith("failed") and got["Voting"]["status"].startswith("failed")
    assert got["LR"]["status"] == "ok" and got["LR"]["mse"] is not None


def test_degenerate_label_is_refused(spark):
    import pytest
    from tabmill.operators import labels
    df = spark.createDataFrame([(1, 1.0), (2, 1.0)], "id long, y double")
    with pytest.raises(ValueError):
        labels.check_two_classes(df, "y")


def test_best_by_ignores_nan(spark):
    from tabmill.operators import evaluate
    df = spark.createDataFrame([("t", "a", 0, float("nan")), ("t", "b", 1, 0.5), ("t", "c", 2, None)], "task string, model string, model_order int, s double")
    assert evaluate.best_by(df, "s", ["task"]).collect()[0]["model"] == "b"


def test_study_from_models_to_findings(spark, sf_small):
    from tabmill.plans import pipeline as P
    from tabmill.plans import study
    from tabmill.plans.tasks import TASK_BY_NAME
    from tabmill.sources.assay import ASSAY_SPEC
    pre = P.preprocess(P.assay_raw(spark, sf_small), ASSAY_SPEC)
    tasks = [TASK_BY_NAME["regression_log_ic50"], TASK_BY_NAME["classification_si_8"]]
    run = study.run_study(pre, tasks, n_draws=1, n_folds=2, light=True, models=["LR"])
    rows = run.results.collect()
    assert [(r["task"], r["model"]) for r in sorted(rows, key=lambda r: (r["task_order"], r["model_order"]))] == [
        (t.name, m) for t in tasks for m in ("LR", "Voting")]
    assert {r["status"] for r in rows} == {"ok"}
    assert {r["model"] for r in run.best_single.collect()} == {"LR"}
    score = {r["task"]: r["score"] for r in run.best_single.collect()}
    lr = {r["task"]: r for r in rows if r["model"] == "LR"}
    assert score["classification_si_8"] == lr["classification_si_8"]["accuracy"] and score["regression_log_ic50"] == lr["regression_log_ic50"]["r2"]
    assert run.overall.count() == 2 and run.regression.count() == 1 and run.classification.count() == 1
