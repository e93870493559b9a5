"""Evaluation tables: regression and classification metrics, confusion
matrix, ROC AUC, average precision, ROC points, best model and top-k
feature importances.

Curves need cumulative counts over scores in descending order. Scores are
first grouped (ties collapse, map-side), then the distinct scores are
range-partitioned; per-range totals give each range its offset, and a window
runs inside each range only. No window ever sees the whole input in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmill.functions.exprs import safe_div
from tabmill.session import materialize


# ---- point metrics ---------------------------------------------------------

def metrics_regression(df: DataFrame, y: str, p: str, group: list[str] | None = None) -> DataFrame:
    """mse, r2, mae (and n) in one aggregate, optionally per group.
    r2 = 1 - SSE / SST with SST = n * var_pop(y), as sklearn's r2_score."""
    group = group or []
    err = F.col(y) - F.col(p)
    g = df.groupBy(*group) if group else df
    out = g.agg(F.count(F.lit(1)).alias("n"),
                F.avg(err * err).alias("mse"),
                F.sum(err * err).alias("sse"),
                (F.var_pop(y) * F.count(F.lit(1))).alias("sst"),
                F.avg(F.abs(err)).alias("mae"))
    return out.select(*group, "n", "mse",
                      (F.lit(1.0) - safe_div(F.col("sse"), F.col("sst"))).alias("r2"), "mae")


def confusion_counts(df: DataFrame, y: str, yhat: str, group: list[str] | None = None) -> DataFrame:
    group = group or []
    g = df.groupBy(*group) if group else df
    yy, pp = F.col(y), F.col(yhat)
    return g.agg(F.count_if((yy == 1) & (pp == 1)).alias("tp"),
                 F.count_if((yy == 0) & (pp == 1)).alias("fp"),
                 F.count_if((yy == 1) & (pp == 0)).alias("fn"),
                 F.count_if((yy == 0) & (pp == 0)).alias("tn"))


def metrics_classification(df: DataFrame, y: str, yhat: str,
                           group: list[str] | None = None) -> DataFrame:
    """accuracy, precision, recall, f1 for class 1; a zero denominator
    gives 0 (sklearn's zero_division default)."""
    group = group or []
    c = confusion_counts(df, y, yhat, group)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return c.select(*group, n.alias("n"),
                    safe_div(tp + tn, n, 0.0).alias("accuracy"),
                    safe_div(tp, tp + fp, 0.0).alias("precision"),
                    safe_div(tp, tp + fn, 0.0).alias("recall"),
                    safe_div(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"))


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Full 2x2 grid (true, predicted, n), zero cells kept, from one
    aggregate: no join with a grid table."""
    c = confusion_counts(df, y, yhat)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    stacks = [F.struct(F.lit(a).alias("true_label"), F.lit(b).alias("pred_label"),
                       F.col(k).cast("bigint").alias("n")) for a, b, k in cells]
    return c.select(F.explode(F.array(*stacks)).alias("s")).select("s.*")


# ---- cumulative curves -----------------------------------------------------

def score_counts(df: DataFrame, y: str, score: str, group: list[str] | None = None) -> DataFrame:
    """(group..., score, pos, neg) per distinct score."""
    group = group or []
    return (df.where(F.col(score).isNotNull())
            .groupBy(*group, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))


def cumulative_desc(st: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Adds tp, fp: positives / negatives of the group with score >= this score.

    The scores are range-partitioned by (group, score descending) and written with the number of their
    range, which fixes the ranges; totals of the ranges, a row each, give every range its offset, so each window
    sees one range of one group, however many scores a group has. A NULL group is a group."""
    group = group or []
    ranged = materialize(st.repartitionByRange(*group, F.desc("score")).withColumn("__r", F.spark_partition_id()), "scores")
    totals = ranged.groupBy(*group, "__r").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__q"))
    before = Window.partitionBy(*group).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias(f"__k_{g}") for g in group], F.col("__r").alias("__kr"),
                            F.coalesce(F.sum("__p").over(before), F.lit(0)).alias("__op"),
                            F.coalesce(F.sum("__q").over(before), F.lit(0)).alias("__oq"))
    within = (Window.partitionBy(*group, "__r").orderBy(F.desc("score"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = ranged.withColumns({"tp": F.sum("pos").over(within), "fp": F.sum("neg").over(within)})
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"__k_{g}")) for g in group], F.col("__r") == F.col("__kr"))
    return out.join(offsets, same).select(*st.columns, (F.col("tp") + F.col("__op")).alias("tp"), (F.col("fp") + F.col("__oq")).alias("fp"))


def _keyed(df: DataFrame, group: list[str] | None) -> tuple[DataFrame, list[str], list[str]]:
    """Grouping keys for the curve jobs; no keys becomes one constant key so
    every join below is an equi-join."""
    if group:
        return df, list(group), list(group)
    return df.withColumn("__g", F.lit(0)), ["__g"], []


def curve_metrics(df: DataFrame, y: str, score: str, group: list[str] | None = None) -> DataFrame:
    """(group..., roc_auc, average_precision) from one cumulative frame.

    AUC counts tied scores half (Mann-Whitney); average precision is the
    step form: sum over distinct scores of recall gained x precision."""
    df, keys, group = _keyed(df, group)
    st = score_counts(df, y, score, keys)
    cum = cumulative_desc(st, keys)
    agg = cum.groupBy(*keys).agg(
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0)).alias("__a"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("__ap"),
        F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    return agg.select(
        *group,
        safe_div(F.col("__a"), F.col("__P").cast("double") * F.col("__N").cast("double"))
        .alias("roc_auc"),
        safe_div(F.col("__ap"), F.col("__P").cast("double")).alias("average_precision"))


def roc_auc(df: DataFrame, y: str, score: str, group: list[str] | None = None) -> DataFrame:
    return curve_metrics(df, y, score, group).select(*(group or []), "roc_auc")


def average_precision(df: DataFrame, y: str, score: str, group: list[str] | None = None) -> DataFrame:
    return curve_metrics(df, y, score, group).select(*(group or []), "average_precision")


def roc_curve(df: DataFrame, y: str, score: str, group: list[str] | None = None) -> DataFrame:
    """(group..., threshold, fpr, tpr) per distinct score, plus the (0, 0)
    start point with threshold NULL. Collinear points are kept."""
    df, keys, group = _keyed(df, group)
    st = score_counts(df, y, score, keys)
    cum = cumulative_desc(st, keys)
    tot = st.groupBy(*keys).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    named = tot.withColumnsRenamed({k: f"__t_{k}" for k in keys})
    cum = cum.join(named, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys]))
    pts = cum.select(*group, F.col("score").alias("threshold"),
                     safe_div(F.col("fp").cast("double"), F.col("__N").cast("double"), 0.0).alias("fpr"),
                     safe_div(F.col("tp").cast("double"), F.col("__P").cast("double"), 0.0).alias("tpr"))
    start = tot.select(*group, F.lit(None).cast("double").alias("threshold"),
                       F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


# ---- model choice and importances -------------------------------------------

def best_by(df: DataFrame, metric: str, partition: list[str] | None = None,
            order_col: str = "model_order") -> DataFrame:
    """First row by metric (descending; NULL and NaN last, as they are no
    score), ties to the earlier model; one row per partition. The window's
    partitions are tasks x models, tiny."""
    partition = partition or []
    score = F.when(~F.isnan(F.col(metric).cast("double")), F.col(metric))
    w = Window.partitionBy(*partition).orderBy(score.desc_nulls_last(), F.asc(order_col))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_k(df: DataFrame, value: str, k: int, tie: str, partition: list[str] | None = None) -> DataFrame:
    """Top-k rows by value (descending), ties by ``tie`` ascending."""
    partition = partition or []
    w = Window.partitionBy(*partition).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
