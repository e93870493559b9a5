"""One modelling task end to end on the processed table: features by
exclusion, audit, split, standardise (fit on train), optional SMOTE on the
train split, tuned models, refit, test metrics, importances, best model and
the voting ensemble. Results use the same evaluation code as the rule
scorers, so every metric has one definition."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.exprs import is_nonfinite
from tabmill.operators import balance, clean, evaluate, findings, labels, scale, split
from tabmill.plans import models as M
from tabmill.plans import tune as TU
from tabmill.plans.pipeline import Preprocessed
from tabmill.plans.tasks import TASKS, Task
from tabmill.session import materialize


@dataclass
class TaskRun:
    results: DataFrame          # (task, model, model_order, status, metrics...)
    predictions: DataFrame      # test rows: (task, model, id, y, p, yhat)
    importances: DataFrame      # (task, model, feature, importance, rank <= 10)
    trials: DataFrame           # (task, model, trial, params, score)


def task_table(pre: Preprocessed, task: Task) -> tuple[DataFrame, list[str]]:
    """(id, features..., y) with the task's target or label."""
    feats = list(pre.kept)
    df = pre.table.select(pre.spec.id, *feats, task.target)
    if task.kind == "regression":
        df = df.withColumn("y", F.col(task.target).cast("double"))
    elif task.rule in ("median_ge", "median_gt"):
        df, _ = labels.label_median(df, task.target, "y", strict=task.rule == "median_gt")
        df = df.withColumn("y", F.col("y").cast("double"))
    else:
        df = labels.label_threshold(df, task.target, "y", task.threshold, task.scale)
        df = df.withColumn("y", F.col("y").cast("double"))
    return df.select(pre.spec.id, *feats, "y"), feats


def prepare(pre: Preprocessed, task: Task, n_folds: int = 5, resample: bool = False,
            k: int = 5) -> M.Prepared:
    df, feats = task_table(pre, task)
    clean.assert_finite(df, feats + ["y"])
    idc = pre.spec.id
    if task.kind == "classification":
        labels.check_two_classes(df, "y")
    df = (split.split_stratified(df, idc, "y") if task.stratify else split.split_random(df, idc))
    train = df.where(F.col("split") == "train").drop("split")
    test = df.where(F.col("split") == "test").drop("split")
    sc = scale.fit_scaler(train, feats)
    train, test = scale.apply_scaler(train, sc), scale.apply_scaler(test, sc)
    train = split.kfold_assign(train, idc, n_folds, label="y" if task.kind == "classification" else None)
    train = materialize(train.select(idc, *feats, "y", "fold"), "train")
    resample = resample and task.kind == "classification"
    if resample:
        bal = labels.class_balance(train, "y").collect()
        resample = bool(bal) and bool(bal[0]["resample"])

    def fit_part(rows: DataFrame) -> DataFrame:
        """The rows a model is fit on: with synthetic minority rows made from these rows alone, so
        neither a source nor a neighbour comes from a validation fold."""
        rows = rows.select(idc, *feats, "y")
        if resample:
            syn, _ = balance.smote(rows, idc, feats, "y", k=k)
            rows = materialize(rows.unionByName(syn.select(*rows.columns)), "resampled")
        return M.assemble(rows, feats)

    folds = [(fit_part(train.where(F.col("fold") != f)), M.assemble(train.where(F.col("fold") == f), feats)) for f in range(n_folds)]
    whole = fit_part(train)
    return M.Prepared(whole, M.assemble(test, feats), feats, whole.count(), folds)


def run_task(pre: Preprocessed, task: Task, n_draws: int | None = None, n_folds: int = 5,
             light: bool = False, models: list[str] | None = None, resample: bool = False,
             parallelism: int = 4, vote_tuned: bool = False) -> TaskRun:
    """``n_draws``: search budget, the task's own by default. ``vote_tuned``: vote with the tuned
    models instead of default members. A model that fails, or the vote, is reported in ``status``
    and the rest goes on."""
    spark = pre.table.sparkSession
    prep = prepare(pre, task, n_folds, resample)
    models = models or M.MODEL_ORDER
    n_draws = n_draws or task.n_draws
    objective = "mse" if task.kind == "regression" else ("accuracy" if task.rule == "threshold" else "f1")
    preds, trials, imps, status, tuned = [], [], [], [], {}

    def add(name: str, order: int, frame: DataFrame) -> None:
        preds.append(frame.select(
            F.lit(task.name).alias("task"), F.lit(name).alias("model"), F.lit(order).alias("model_order"),
            F.col(pre.spec.id).alias("id"), "y", F.col("p").cast("double").alias("p"),
            (F.col("yhat") if task.kind == "classification" else F.lit(None).cast("int")).alias("yhat")))

    for order, name in enumerate(models):
        draws = TU.draws_for(name, task.kind, task.rule == "threshold", n_draws, light)
        fixed = {"maxIter": 2000 if task.rule != "threshold" else 1000} \
            if name == "LR" and task.kind == "classification" else {}
        try:
            best, params, tr = TU.tune(prep.train, name, task.kind, draws, prep.folds, objective,
                                       prep.n_train, parallelism, fixed)
            add(name, order, M.predict(best, prep.test, task.kind))
            score = _train_score(best, prep.train, task)
        except Exception as e:  # one failing model is reported, the rest go on
            status.append((task.name, name, order, f"failed: {type(e).__name__}: {str(e)[:200]}", None))
            continue
        tuned[name] = params
        trials += [(task.name, name, *t) for t in tr]
        status.append((task.name, name, order, "ok", score))
        if hasattr(best, "featureImportances"):
            imps += [(task.name, name, f, v) for f, v in M.importances(best, prep.features)]
    try:
        base = M.LIGHT if light else M.DEFAULTS
        params = {m: {**base.get(m, {}), **(tuned.get(m, {}) if vote_tuned else {})} for m in M.VOTE_MEMBERS}
        members = M.fit_vote(prep.train, task.kind, params=params, n_train=prep.n_train)
        add("Voting", len(models), M.predict_vote(members, prep.test, task.kind))
        status.append((task.name, "Voting", len(models), "ok", None))
    except Exception as e:
        status.append((task.name, "Voting", len(models), f"failed: {type(e).__name__}: {str(e)[:200]}", None))
    st = spark.createDataFrame(
        status, "task string, model string, model_order int, status string, train_score double")
    empty = "task string, model string, model_order int, id bigint, y double, p double, yhat int"
    allp = reduce(DataFrame.unionByName, preds) if preds else spark.createDataFrame([], empty)
    allp = allp.withColumn("split", F.lit("test"))
    results, dropped = _results(allp, task)
    results = results.join(st, ["task", "model", "model_order"], "right").withColumn(
        "status", F.when(F.col("model").isin(dropped or [""]), "dropped: predictions that are not finite").otherwise(F.col("status")))
    imp = spark.createDataFrame(imps or [], "task string, model string, feature string, importance double")
    imp = evaluate.top_k(imp, "importance", 10, "feature", ["task", "model"])
    tr = spark.createDataFrame(trials or [], "task string, model string, trial int, params string, score double")
    return TaskRun(results, allp, imp, tr)


def _train_score(model, train: DataFrame, task: Task) -> float:
    """The overfit check: R2 (regression), accuracy (threshold task) or F1
    of class 1 on the train split the model was fit on."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    if task.kind == "regression":
        ev = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName="r2")
    elif task.rule == "threshold":
        ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction",
                                               metricName="accuracy")
    else:
        ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction",
                                               metricName="fMeasureByLabel", metricLabel=1.0)
    return float(ev.evaluate(model.transform(train)))


def _results(preds: DataFrame, task: Task) -> tuple[DataFrame, list[str]]:
    """Metrics of the models whose predictions are all finite, and the names of the others."""
    from tabmill.plans.tasks import results_for
    bad = (preds.groupBy("model").agg(F.count_if(is_nonfinite("p")).alias("bad"))
           .where("bad > 0").collect())
    dropped = [r["model"] for r in bad]
    keep = preds.where(~F.col("model").isin(dropped or [""]))
    return results_for(keep, [task]).drop("task_order"), dropped


@dataclass
class StudyRun:
    results: DataFrame         # every model of every task, votes included
    best_single: DataFrame     # (task, model, score): by the task's metric, without the vote
    board: DataFrame           # the best row of every task
    regression: DataFrame
    classification: DataFrame
    overall: DataFrame


def run_study(pre: Preprocessed, tasks: list[Task] = TASKS, **settings) -> StudyRun:
    """All tasks, from trained models to the findings. Classification tasks are resampled where the classes call
    for it; ``settings`` go to ``run_task``. Each task's results are written before the next begins."""
    parts = []
    for order, task in enumerate(tasks):
        run = run_task(pre, task, resample=task.kind == "classification", **settings)
        named = run.results.withColumn("kind", F.lit(task.kind)).withColumn("task_order", F.lit(order))
        parts.append(materialize(named, f"results-{task.name}"))
    results = reduce(DataFrame.unionByName, parts)
    by_accuracy = F.col("task").isin([t.name for t in tasks if t.metric == "accuracy"] or [""])
    single = results.where(F.col("model") != "Voting").withColumn(
        "score", F.when(F.col("kind") == "regression", F.col("r2")).when(by_accuracy, F.col("accuracy")).otherwise(F.col("f1")))
    board = findings.leaderboard(results)
    return StudyRun(
        results, evaluate.best_by(single, "score", ["task"]).select("task", "model", "score"), board,
        findings.findings_regression(board),
        findings.findings_classification(board, [t.name for t in tasks if t.rule == "threshold"]),
        findings.findings_overall(board, "regression_log_si", "classification_si_8"))
