"""Leaderboard and rule-based findings over a results table
(task, kind, model, model_order, metrics...), plus the Markdown table rows
and the compound triage. All are projections, `when` chains and small
windows over a table of tasks x models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.operators.evaluate import best_by

# fixed values: thresholds of the report's findings
R2_LOW = 0.5
R2_HARD = 0.3
F1_LOW = 0.65
PRECISION_LOW = 0.6
RECALL_LOW = 0.7
F1_HIGH = 0.8

REG_COLUMNS = ["model", "mse", "r2", "mae"]
CLF_COLUMNS = ["model", "accuracy", "f1", "precision", "recall", "roc_auc", "pr_auc"]


def with_score(results: DataFrame) -> DataFrame:
    """score = r2 for regression rows, f1 for classification rows."""
    return results.withColumn(
        "score", F.when(F.col("kind") == "regression", F.col("r2")).otherwise(F.col("f1")))


def leaderboard(results: DataFrame) -> DataFrame:
    """Best row per task by its score (first model on ties), vote included."""
    return best_by(with_score(results), "score", ["task"])


def findings_regression(board: DataFrame) -> DataFrame:
    """R2 below 0.5 is low; a missing R2 gives no number, not an error."""
    r = board.where(F.col("kind") == "regression")
    return r.select("task", "model", "r2",
                    F.when(F.col("r2").isNull(), "missing")
                    .when(F.col("r2") < R2_LOW, "low").otherwise("acceptable").alias("finding"))


def findings_classification(board: DataFrame, threshold_tasks: list[str]) -> DataFrame:
    """Low when F1 < .65 or precision < .6 or recall < .7; threshold tasks
    also get the F1-only finding."""
    c = board.where(F.col("kind") == "classification")
    low = (F.col("f1") < F1_LOW) | (F.col("precision") < PRECISION_LOW) | (F.col("recall") < RECALL_LOW)
    thr = F.when(~F.col("task").isin(threshold_tasks or [""]), F.lit(None).cast("string")) \
        .when(F.col("f1").isNull(), "missing") \
        .when(F.col("f1") < F1_LOW, "low").otherwise("high")
    return c.select("task", "model", "f1", "precision", "recall",
                    F.when(F.col("f1").isNull(), "missing").when(low, "low")
                    .otherwise("acceptable").alias("finding"),
                    thr.alias("threshold_finding"))


def findings_overall(board: DataFrame, hard_task: str, effective_task: str) -> DataFrame:
    """One line per task: the best model and its score; flags for a hard
    regression target (R2 < .3) and a strong effective-compound classifier
    (F1 >= .8)."""
    flag = (F.when((F.col("task") == hard_task) & (F.col("r2") < R2_HARD), "hard_to_predict")
            .when((F.col("task") == effective_task) & (F.col("f1") >= F1_HIGH), "identifies_effective"))
    return board.select("task", "model", F.col("score"), flag.alias("flag"))


def _fmt(c: str):
    """A number as str(round(x, 3)) prints it; NULL as nan."""
    return F.coalesce((F.round(F.col(c), 3) + F.lit(0.0)).cast("string"), F.lit("nan"))


def markdown_rows(results: DataFrame, curve_tasks: list[str]) -> DataFrame:
    """(task, model_order, line) Markdown table rows; classification tasks
    without curves show no AUC columns."""
    reg = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col("model")] + [_fmt(c) for c in REG_COLUMNS[1:]]),
                   F.lit(" |"))
    clf_all = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col("model")] + [_fmt(c) for c in CLF_COLUMNS[1:]]),
                       F.lit(" |"))
    clf_short = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col("model")] + [_fmt(c) for c in CLF_COLUMNS[1:5]]),
                         F.lit(" |"))
    line = (F.when(F.col("kind") == "regression", reg)
            .when(F.col("task").isin(curve_tasks or [""]), clf_all).otherwise(clf_short))
    return results.select("task", "model_order", line.alias("line"))


def dataset_summary(info: DataFrame, stage: str = "before") -> DataFrame:
    """The report's dataset line from the two-stage info table."""
    return info.where(F.col("stage") == stage).select(
        "stage", F.format_string("%d rows, %d columns, %d missing cells",
                                 F.col("rows"), F.col("columns"), F.col("missing_values")).alias("line"))


def triage(df: DataFrame, ic50_label: str, cc50_label: str, si_label: str) -> DataFrame:
    """dangerous (low CC50) first; effective: low IC50 and high SI;
    ineffective: high IC50 and low SI; otherwise undetermined."""
    t = (F.when(F.col(cc50_label) == 0, "dangerous")
         .when((F.col(ic50_label) == 0) & (F.col(si_label) == 1), "effective")
         .when((F.col(ic50_label) == 1) & (F.col(si_label) == 0), "ineffective")
         .otherwise("undetermined"))
    return df.withColumn("triage", t)
