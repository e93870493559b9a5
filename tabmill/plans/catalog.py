"""Registered queries: each key has a Spark callable ``(spark, sf_dir) ->
DataFrame`` and, where SQL can express it, the DuckDB oracle text.

Every query reads the whole test tables (through the ``assay`` build or
directly); nothing is sampled or capped except where a limit is the
feature (top-k)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.functions.exprs import rnd
from tabmill.operators import chartdata, clean, evaluate, findings, labels, profile, scale, select, split
from tabmill.plans import pipeline as P
from tabmill.plans import sqlgen as S
from tabmill.plans import tasks as T
from tabmill.plans.tasks import TASK_BY_NAME, TASKS
from tabmill.session import materialize
from tabmill.sources.assay import ASSAY_SPEC, FEATURES, TARGETS
from tabmill.sources.tables import read_table
from tabmill.trees.boosting import BoostParams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _assay_written(spark, sf) -> DataFrame:
    """The fixture written once to the checkpoint folder, for queries that
    run several fit jobs over it (each would otherwise redo the joins)."""
    return materialize(P.assay_raw(spark, sf), "assay")


def _dedup_written(spark, sf) -> DataFrame:
    """The deduplicated fixture written once, as the pipeline does."""
    return materialize(P.stage_dedup(P.assay_raw(spark, sf)), "dedup")


def round_all(df: DataFrame, digits: int, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (same arithmetic as DuckDB's round)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in skip:
            out.append(rnd(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---- A: sources -----------------------------------------------------------

@query("load_raw", S.with_ctes() + "SELECT " + ", ".join(
    ["id", *[f"round({c}, 6) AS {c}" for c in TARGETS], *[
        (f"round({c}, 6) AS {c}" if c not in ("nation", "n_lines", "n_parts", "yr") else c)
        for c in FEATURES]]) + " FROM assay")
def q_load_raw(spark, sf):
    return round_all(P.assay_raw(spark, sf), 6)


@query("audit_nonfinite", S.with_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"count(*) FILTER (WHERE isnan(CAST({c} AS DOUBLE))) AS n_nan, "
    f"count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS n_inf FROM assay"
    for c in S.ASSAY_COLS))
def q_audit(spark, sf):
    return clean.audit_nonfinite(P.assay_raw(spark, sf))


# ---- B: shape -------------------------------------------------------------

@query("dup_count", S.with_ctes() +
       "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM assay)) "
       "AS distinct_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM assay)) "
       "AS duplicates FROM assay")
def q_dup_count(spark, sf):
    return clean.dup_count(P.assay_raw(spark, sf))


@query("dup_count_events",
       "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) "
       "AS distinct_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) "
       "AS duplicates FROM events")
def q_dup_count_events(spark, sf):
    ev = read_table(spark, sf, "events").select("user_id", "event_type")
    return clean.dup_count(ev)


@query("dedup_rows",
       "SELECT DISTINCT user_id, event_type FROM events")
def q_dedup_rows(spark, sf):
    ev = read_table(spark, sf, "events").select("user_id", "event_type")
    return clean.dedup_rows(ev)


@query("rename_targets", S.with_ctes() +
       "SELECT id, round(ic50, 4) AS ic50_mm, round(cc50, 4) AS cc50_mm, round(si, 4) AS si FROM assay")
def q_rename_targets(spark, sf):
    df = P.assay_raw(spark, sf).select("id", *TARGETS)
    return round_all(clean.rename_columns(df, {"ic50": "ic50_mm", "cc50": "cc50_mm"}), 4)


_RENAMED = {c: f"feature_{i}" for i, c in enumerate(S.ASSAY_COLS) if c not in TARGETS}


@query("rename_features", S.with_ctes() + "SELECT " + ", ".join(
    f"round(CAST({c} AS DOUBLE), 6) AS {_RENAMED.get(c, c)}" for c in S.ASSAY_COLS) + " FROM assay")
def q_rename_features(spark, sf):
    df, _ = clean.rename_features(P.assay_raw(spark, sf), keep=TARGETS)
    return df.select(*[rnd(F.col(c).cast("double"), 6).alias(c) for c in df.columns])


@query("drop_columns", S.with_ctes() +
       "SELECT id, round(ic50, 6) AS ic50, round(acctbal, 6) AS acctbal, n_lines FROM assay")
def q_drop_columns(spark, sf):
    df = P.assay_raw(spark, sf).select("id", "ic50", "acctbal", "nation", "n_lines")
    return round_all(clean.drop_columns(df, ["nation", "not_a_column"]), 6)


@query("project_features", S.with_ctes() + "SELECT " + ", ".join(
    [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FEATURES + TARGETS]) + " FROM assay")
def q_project_features(spark, sf):
    df = P.assay_raw(spark, sf)
    out = clean.project_features(df, exclude=["id"], keep_last=TARGETS)
    return out.select(*[rnd(F.col(c).cast("double"), 6).alias(c) for c in out.columns])


@query("project_numeric", "SELECT doc_id, n_chars FROM documents")
def q_project_numeric(spark, sf):
    return clean.project_numeric(read_table(spark, sf, "documents"))


# ---- C: profile -----------------------------------------------------------

@query("outlier_counts", S.with_ctes(S.fences_cte("assay", TARGETS)) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT count(*) FROM assay, fences "
    f"WHERE {c} < {c}_lo OR {c} > {c}_hi) AS n_outliers, round({c}_lo, 4) AS lower, "
    f"round({c}_hi, 4) AS upper FROM fences" for c in TARGETS))
def q_outlier_counts(spark, sf):
    return profile.outlier_counts(_assay_written(spark, sf), TARGETS)


@query("quantiles", S.with_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {q} AS q, round(quantile_cont({c}, {q}), 4) AS value FROM assay"
    for c in TARGETS + ["acctbal", "n_lines"] for q in ("0.25", "0.5", "0.75")))
def q_quantiles(spark, sf):
    return profile.quantiles_table(_assay_written(spark, sf), TARGETS + ["acctbal", "n_lines"],
                                   [0.25, 0.5, 0.75])


def _describe_sql(src: str, cols: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS feature, count({c}) AS count, round(avg({c}), 2) AS mean, "
        f"round(stddev_samp({c}), 2) AS std, round(min({c}), 2) AS min, "
        f"round(quantile_cont({c}, 0.25), 2) AS q25, round(quantile_cont({c}, 0.5), 2) AS q50, "
        f"round(quantile_cont({c}, 0.75), 2) AS q75, round(max({c}), 2) AS max FROM {src}"
        for c in cols)


@query("describe_table", S.with_ctes() + _describe_sql("assay", S.ASSAY_COLS))
def q_describe(spark, sf):
    return profile.describe_table(_assay_written(spark, sf))


def _info_sql(src: str, stage: str, cols: list[str], outlier_cols: list[str],
              dtypes: dict[str, int], all_dtypes: list[str]) -> str:
    miss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    outl = ", ".join(
        f"(SELECT count(*) FROM {src}, {stage}_f WHERE {c} < {c}_lo OR {c} > {c}_hi) AS outliers_{c}"
        for c in outlier_cols)
    dt = ", ".join(f"CAST({dtypes.get(t, 0)} AS BIGINT) AS dtype_{t}" for t in all_dtypes)
    return (f"SELECT '{stage}' AS stage, count(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns, "
            f"{miss} AS missing_values, {dt}, {outl} FROM {src}")


_RAW_DTYPES = {"bigint": 3, "double": 13, "int": 2}


@query("profile_info", S.with_ctes(S.fences_cte("assay", TARGETS, "before_f")) +
       _info_sql("assay", "before", S.ASSAY_COLS, TARGETS, _RAW_DTYPES, sorted(_RAW_DTYPES)))
def q_profile_info(spark, sf):
    return profile.profile_info(_assay_written(spark, sf), "before", TARGETS)


# ---- D: cleaning ----------------------------------------------------------

_CLEAN_COLS = ["id", *TARGETS, *FEATURES]


@query("clip_iqr", S.with_ctes(*S.clipped_ctes()) + "SELECT id, " +
       S.rounded(TARGETS, 4) + " FROM clipped")
def q_clip(spark, sf):
    df = _dedup_written(spark, sf)
    out, _ = P.stage_clip(df, ASSAY_SPEC)
    return round_all(out.select("id", *TARGETS), 4)


@query("clip_report", S.with_ctes(*S.clipped_ctes()) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT count(*) FROM dedup, fences WHERE {c} < {c}_lo OR {c} > {c}_hi) "
    f"AS n_outliers, round({c}_lo, 4) AS lower, round({c}_hi, 4) AS upper FROM fences"
    for c in TARGETS))
def q_clip_report(spark, sf):
    df = _dedup_written(spark, sf)
    return profile.outlier_counts(df, TARGETS)


@query("impute_median", S.with_ctes(*S.imputed_ctes()) + "SELECT id, " +
       S.rounded(S.NUMERIC_NO_ID, 6) + " FROM imputed")
def q_impute_median(spark, sf):
    df = _dedup_written(spark, sf)
    df, _ = P.stage_clip(df, ASSAY_SPEC)
    df, _ = P.stage_impute(df, ASSAY_SPEC)
    return round_all(df, 6)


@query("impute_mode",
       "WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang, nullif(source, 'src0') AS source, "
       "CAST(NULL AS VARCHAR) AS note FROM documents), "
       "m_lang AS (SELECT lang AS v FROM d WHERE lang IS NOT NULL GROUP BY lang "
       "ORDER BY count(*) DESC, lang LIMIT 1), "
       "m_src AS (SELECT source AS v FROM d WHERE source IS NOT NULL GROUP BY source "
       "ORDER BY count(*) DESC, source LIMIT 1) "
       "SELECT doc_id, coalesce(lang, (SELECT v FROM m_lang), 'Unknown') AS lang, "
       "coalesce(source, (SELECT v FROM m_src), 'Unknown') AS source, "
       "coalesce(note, 'Unknown') AS note FROM d")
def q_impute_mode(spark, sf):
    d = read_table(spark, sf, "documents").select(
        "doc_id", F.expr("nullif(lang, 'en')").alias("lang"),
        F.expr("nullif(source, 'src0')").alias("source"),
        F.lit(None).cast("string").alias("note"))
    out, _ = clean.impute_mode(d, ["lang", "source", "note"])
    return out


@query("floor_positive",
       S.with_ctes("nonpos AS (SELECT count(*) FILTER (WHERE acctbal <= 0) AS acctbal, "
                   "count(*) FILTER (WHERE cc50 <= 0) AS cc50 FROM assay)") +
       "SELECT id, round(CASE WHEN n.acctbal > 0 AND a.acctbal < 1e-6 THEN 1e-6 ELSE a.acctbal END, 6) "
       "AS acctbal, round(CASE WHEN n.cc50 > 0 AND a.cc50 < 1e-6 THEN 1e-6 ELSE a.cc50 END, 6) AS cc50 "
       "FROM assay a, nonpos n")
def q_floor(spark, sf):
    df = P.assay_raw(spark, sf).select("id", "acctbal", "cc50")
    out, _ = clean.floor_positive(df, ["acctbal", "cc50"])
    return round_all(out, 6)


@query("floor_counts",
       S.with_ctes() + "SELECT 'acctbal' AS feature, count(*) FILTER (WHERE acctbal <= 0) AS n_nonpositive "
       "FROM assay UNION ALL SELECT 'cc50', count(*) FILTER (WHERE cc50 <= 0) FROM assay")
def q_floor_counts(spark, sf):
    df = P.assay_raw(spark, sf)
    _, counts = clean.floor_positive(df, ["acctbal", "cc50"])
    return spark.createDataFrame(list(counts.items()), "feature string, n_nonpositive bigint")


@query("log_targets", S.with_ctes(*S.logged_ctes()) + "SELECT id, " +
       S.rounded(S.LOGS, 6) + " FROM logged")
def q_log_targets(spark, sf):
    return round_all(_logged(spark, sf).select("id", *S.LOGS), 6)


# ---- E: selection ---------------------------------------------------------

def _logged(spark, sf) -> DataFrame:
    return P.logged_stage(P.assay_raw(spark, sf), ASSAY_SPEC)[0]


@query("corr_matrix", S.with_ctes(*S.logged_ctes()) +
       f"SELECT a, b, pos_a, pos_b, round(r, 6) AS r FROM ({S.corr_pairs_sql('logged', FEATURES)})")
def q_corr_matrix(spark, sf):
    c = select.corr_matrix(_logged(spark, sf), FEATURES)
    return c.select("a", "b", "pos_a", "pos_b", rnd("r", 6).alias("r"))


@query("corr_drop", S.with_ctes(*S.selected_ctes()) +
       "SELECT c.feature, p.position FROM corr_dropped c JOIN positions p USING (feature)")
def q_corr_drop(spark, sf):
    return select.corr_drop(select.corr_matrix(_logged(spark, sf), FEATURES), P.CORR_THRESHOLD)


@query("variance_filter", S.with_ctes(*S.selected_ctes()) +
       "SELECT p.feature, p.position, round(v.variance, 2) AS variance, "
       "(k.feature IS NOT NULL) AS kept FROM positions p JOIN variances v USING (feature) "
       "LEFT JOIN kept k USING (feature)")
def q_variance_filter(spark, sf):
    df = _logged(spark, sf)
    dropped = select.corr_drop_list(df, FEATURES, P.CORR_THRESHOLD)
    kept = set(select.variance_keep(df, [c for c in FEATURES if c not in dropped],
                                    P.VARIANCE_THRESHOLD))
    v = select.variances(df, FEATURES)
    return v.select("feature", "position", rnd("variance", 2).alias("variance"),
                    F.col("feature").isin(list(kept) or [""]).alias("kept"))


# ---- F: labels ------------------------------------------------------------

@query("label_median_ge", S.with_ctes(*S.logged_ctes()) +
       "SELECT id, CAST(ic50 >= (SELECT median(ic50) FROM logged) AS INTEGER) AS label FROM logged")
def q_label_ge(spark, sf):
    out, _ = labels.label_median(_logged(spark, sf).select("id", "ic50"), "ic50", "label")
    return out.select("id", "label")


@query("label_median_gt", S.with_ctes(*S.logged_ctes()) +
       "SELECT id, CAST(si > (SELECT median(si) FROM logged) AS INTEGER) AS label FROM logged")
def q_label_gt(spark, sf):
    out, _ = labels.label_median(_logged(spark, sf).select("id", "si"), "si", "label", strict=True)
    return out.select("id", "label")


@query("label_threshold", S.with_ctes(*S.logged_ctes()) +
       "SELECT id, CAST(log_si >= log10(8) AS INTEGER) AS label, "
       "CAST(log_si >= ln(1 + 8) AS INTEGER) AS label_same_scale FROM logged")
def q_label_threshold(spark, sf):
    df = _logged(spark, sf).select("id", "log_si")
    df = labels.label_threshold(df, "log_si", "label", 8.0, "log10")
    df = labels.label_threshold(df, "log_si", "label_same_scale", 8.0, "log1p")
    return df.select("id", "label", "label_same_scale")


@query("class_balance", S.with_ctes(
    *S.logged_ctes(),
    "lab AS (SELECT CAST(log_si >= log10(8) AS INTEGER) AS label FROM logged)",
    "vc AS (SELECT label, count(*) AS n, count(*) / (SELECT count(*) FROM lab) AS share "
    "FROM lab GROUP BY label)",
    "st AS (SELECT max(share) - min(share) > 0.1 AS imb, min(n) AS minority FROM vc)") +
    "SELECT label, n, share, st.imb AS imbalanced, st.imb AND st.minority >= 5 AS resample FROM vc, st")
def q_class_balance(spark, sf):
    df = labels.label_threshold(_logged(spark, sf).select("log_si"), "log_si", "label", 8.0, "log10")
    return labels.class_balance(df, "label")


# ---- G: splits --------------------------------------------------------------

@query("split_random", S.with_ctes() +
       f"SELECT id, CASE WHEN {S.hash_u('id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM assay")
def q_split_random(spark, sf):
    return split.split_random(P.assay_raw(spark, sf).select("id"), "id")


@query("split_stratified", S.with_ctes(*S.logged_ctes(), *S.task_ctes(TASK_BY_NAME["classification_ic50_median"], 0)[:5]) +
       "SELECT id, y AS label, split FROM t0")
def q_split_stratified(spark, sf):
    df, _ = labels.label_median(_logged(spark, sf).select("id", "ic50"), "ic50", "label")
    return split.split_stratified(df, "id", "label").select("id", "label", "split")


@query("kfold_assign", S.with_ctes() +
       f"SELECT id, CAST(floor({S.hash_u('id', 42, 'fold')} * 5.0) AS INTEGER) AS fold FROM assay")
def q_kfold(spark, sf):
    return split.kfold_assign(P.assay_raw(spark, sf).select("id"), "id")


@query("standardize", S.with_ctes(
    *S.selected_ctes(),
    f"sp AS (SELECT *, CASE WHEN {S.hash_u('id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM logged)",
    "lg AS (UNPIVOT (SELECT id, split, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    + " FROM sp) ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE v)",
    "fit AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS s FROM lg WHERE split = 'train' GROUP BY feature)") +
    "SELECT l.id, l.feature, l.split, round((l.v - f.m) / CASE WHEN f.s = 0 OR f.s IS NULL THEN 1.0 ELSE f.s END, 6) "
    "AS z FROM lg l JOIN fit f USING (feature) WHERE l.feature IN (SELECT feature FROM kept)")
def q_standardize(spark, sf):
    df = _logged(spark, sf)
    dropped = select.corr_drop_list(df, FEATURES, P.CORR_THRESHOLD)
    kept = select.variance_keep(df, [c for c in FEATURES if c not in dropped], P.VARIANCE_THRESHOLD)
    df = split.split_random(df.select("id", *kept), "id")
    sc = scale.fit_scaler(df.where("split = 'train'"), kept)
    z = scale.apply_scaler(df, sc)
    long = z.unpivot(["id", "split"], kept, "feature", "z")
    return long.select("id", "feature", "split", rnd("z", 6).alias("z"))


# ---- J: evaluation ------------------------------------------------------------

def _preds(spark, sf, task_names: list[str] | None = None) -> DataFrame:
    tasks = [t for t in TASKS if task_names is None or t.name in task_names]
    return T.all_rule_predictions(_logged(spark, sf), tasks)


def _preds_sql(task_names: list[str], *more: str) -> str:
    tasks = [t for t in TASKS if t.name in task_names]
    return S.with_ctes(*S.logged_ctes(), *S.preds_ctes(tasks), *more)


@query("metrics_regression", _preds_sql(["regression_log_ic50"]) +
       "SELECT model, count(*) AS n, round(avg((y - p) * (y - p)), 6) AS mse, "
       "round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 6) + 0.0 AS r2, "
       "round(avg(abs(y - p)), 6) AS mae FROM preds WHERE split = 'test' GROUP BY model")
def q_metrics_regression(spark, sf):
    p = _preds(spark, sf, ["regression_log_ic50"]).where("split = 'test'")
    m = evaluate.metrics_regression(p, "y", "p", ["model"])
    return round_all(m, 6)


@query("metrics_by_split", _preds_sql(["regression_log_ic50", "classification_si_8"]) +
       "SELECT task, model, split, count(*) AS n, "
       "round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 6) + 0.0 AS r2, "
       "round(CASE WHEN count(*) FILTER (WHERE yhat IS NOT NULL) = 0 THEN NULL ELSE "
       "count(*) FILTER (WHERE y = yhat) / count(*) END, 6) AS accuracy "
       "FROM preds GROUP BY task, model, split")
def q_metrics_by_split(spark, sf):
    p = _preds(spark, sf, ["regression_log_ic50", "classification_si_8"])
    err = F.col("y") - F.col("p")
    out = p.groupBy("task", "model", "split").agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop("y") * F.count(F.lit(1)))).alias("r2"),
        F.when(F.count("yhat") > 0, F.count_if(F.col("y") == F.col("yhat")) / F.count(F.lit(1)))
        .alias("accuracy"))
    return round_all(out, 6)


@query("metrics_classification", _preds_sql(["classification_ic50_median"]) +
       "SELECT model, tp + fp + fn + tn AS n, "
       "round(CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END, 6) AS accuracy, "
       "round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision, "
       "round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall, "
       "round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM ("
       "SELECT model, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, "
       "count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, "
       "count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn FROM preds WHERE split = 'test' GROUP BY model)")
def q_metrics_classification(spark, sf):
    p = _preds(spark, sf, ["classification_ic50_median"]).where("split = 'test'")
    return round_all(evaluate.metrics_classification(p, "y", "yhat", ["model"]), 6)


@query("confusion_matrix", _preds_sql(["classification_ic50_median"]) +
       "SELECT t.true_label, t.pred_label, count(p.id) AS n FROM "
       "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(true_label, pred_label) LEFT JOIN "
       "(SELECT * FROM preds WHERE split = 'test' AND model = 'rule_sum_price') p "
       "ON p.y = t.true_label AND p.yhat = t.pred_label GROUP BY t.true_label, t.pred_label")
def q_confusion(spark, sf):
    p = _preds(spark, sf, ["classification_ic50_median"]).where(
        "split = 'test' AND model = 'rule_sum_price'")
    return evaluate.confusion_matrix(p, "y", "yhat")


_CURVE_SQL = _preds_sql(
    ["classification_ic50_median"],
    "sc AS (SELECT model, p AS score, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos, "
    "CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE) AS neg FROM preds WHERE split = 'test' GROUP BY model, p)",
    "cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM sc WINDOW w AS "
    "(PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))")


@query("roc_auc", _CURVE_SQL +
       "SELECT model, round(sum(neg * (tp - pos + pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc "
       "FROM cum GROUP BY model")
def q_roc_auc(spark, sf):
    p = _preds(spark, sf, ["classification_ic50_median"]).where("split = 'test'")
    return round_all(evaluate.roc_auc(p, "y", "p", ["model"]), 6)


@query("average_precision", _CURVE_SQL +
       "SELECT model, round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS average_precision "
       "FROM cum GROUP BY model")
def q_average_precision(spark, sf):
    p = _preds(spark, sf, ["classification_ic50_median"]).where("split = 'test'")
    return round_all(evaluate.average_precision(p, "y", "p", ["model"]), 6)


@query("roc_curve", _CURVE_SQL +
       "SELECT model, round(score, 9) AS threshold, round(fp / sum(neg) OVER (PARTITION BY model), 6) AS fpr, "
       "round(tp / sum(pos) OVER (PARTITION BY model), 6) AS tpr FROM cum "
       "UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM sc")
def q_roc_curve(spark, sf):
    p = _preds(spark, sf, ["classification_ic50_median"]).where("split = 'test'")
    c = evaluate.roc_curve(p, "y", "p", ["model"])
    return c.select("model", rnd("threshold", 9).alias("threshold"),
                    rnd("fpr", 6).alias("fpr"), rnd("tpr", 6).alias("tpr"))


_RESULT_COLS = ["task", "kind", "model", "model_order", "n", "mse", "r2", "mae", "accuracy",
                "precision", "recall", "f1", "roc_auc", "pr_auc", "task_order"]


def _results(spark, sf) -> DataFrame:
    return T.results_for(_preds(spark, sf), TASKS)


def _results_sql(*more: str) -> str:
    return S.with_ctes(*S.results_ctes(TASKS), *more)


@query("results_table", _results_sql() + "SELECT * FROM results")
def q_results(spark, sf):
    return _results(spark, sf)


def _with_vote(preds: DataFrame) -> DataFrame:
    """Adds the mean of each task's scorers as the model Voting, in the last place."""
    vote = preds.groupBy("task", "split", "id", "y").agg(F.avg("p").alias("p"), F.max("model_order").alias("o"))
    kind = F.col("task").startswith("classification")
    return preds.unionByName(vote.select(
        "task", F.lit("Voting").alias("model"), (F.col("o") + 1).alias("model_order"), "split", "id", "y", "p",
        F.when(kind, (F.col("p") > 0.5).cast("int")).alias("yhat")))


_METRIC_SQL = ("CASE WHEN kind = 'regression' THEN r2 WHEN task IN ("
               + ", ".join(f"'{t.name}'" for t in TASKS if t.metric == "accuracy") + ") THEN accuracy ELSE f1 END")
_VOTE_RESULTS = _results_sql().replace(
    "preds AS (", "preds0 AS (", 1).replace(
    "reg AS (", "preds AS (SELECT * FROM preds0 UNION ALL SELECT task, 'Voting', max(model_order) + 1, split, id, y, avg(p), "
    "CASE WHEN task LIKE 'classification%' THEN CAST(avg(p) > 0.5 AS INTEGER) END FROM preds0 GROUP BY task, split, id, y), reg AS (", 1)


@query("best_single_model", _VOTE_RESULTS +
       f"SELECT task, model, {_METRIC_SQL} AS score FROM ("
       f"SELECT *, row_number() OVER (PARTITION BY task ORDER BY {_METRIC_SQL} DESC NULLS LAST, model_order) AS rn FROM results "
       "WHERE model <> 'Voting') WHERE rn = 1")
def q_best_single(spark, sf):
    """Best single model per task by the task's own metric: the vote is in the table and is left out."""
    r = T.results_for(_with_vote(_preds(spark, sf)), TASKS).where(F.col("model") != "Voting")
    by_accuracy = F.col("task").isin([t.name for t in TASKS if t.metric == "accuracy"])
    r = r.withColumn("score", F.when(F.col("kind") == "regression", F.col("r2")).when(by_accuracy, F.col("accuracy")).otherwise(F.col("f1")))
    return evaluate.best_by(r, "score", ["task"]).select("task", "model", "score")


@query("results_with_vote", _VOTE_RESULTS + "SELECT * FROM results")
def q_results_with_vote(spark, sf):
    return T.results_for(_with_vote(_preds(spark, sf)), TASKS)


# ---- L: leaderboard and findings ------------------------------------------

_BOARD_SQL = ("board AS (SELECT * EXCLUDE (rn) FROM (SELECT *, CASE WHEN kind = 'regression' THEN r2 "
              "ELSE f1 END AS score, row_number() OVER (PARTITION BY task ORDER BY CASE WHEN kind = "
              "'regression' THEN r2 ELSE f1 END DESC, model_order) AS rn FROM results) WHERE rn = 1)")


@query("leaderboard", _results_sql(_BOARD_SQL) + "SELECT * FROM board")
def q_leaderboard(spark, sf):
    return findings.leaderboard(_results(spark, sf))


@query("leaderboard_load", _results_sql() + "SELECT * FROM results")
def q_leaderboard_load(spark, sf):
    """Write the results table partitioned by task, read the folder back."""
    from tabmill.sources.tables import write_table
    from tabmill.session import ensure_checkpoint_dir
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabmill/results-{uuid.uuid4().hex}"
    write_table(_results(spark, sf), path, partition_by=["task"])
    return spark.read.parquet(path)


@query("findings_regression", _results_sql(_BOARD_SQL) +
       "SELECT task, model, r2, CASE WHEN r2 IS NULL THEN 'missing' WHEN r2 < 0.5 THEN 'low' "
       "ELSE 'acceptable' END AS finding FROM board WHERE kind = 'regression'")
def q_findings_regression(spark, sf):
    return findings.findings_regression(findings.leaderboard(_results(spark, sf)))


_THRESHOLD_TASKS = [t.name for t in TASKS if t.rule == "threshold"]
_CURVE_TASKS = [t.name for t in TASKS if t.kind == "classification" and t.curves]


@query("findings_classification", _results_sql(_BOARD_SQL) +
       "SELECT task, model, f1, precision, recall, CASE WHEN f1 IS NULL THEN 'missing' "
       "WHEN f1 < 0.65 OR precision < 0.6 OR recall < 0.7 THEN 'low' ELSE 'acceptable' END AS finding, "
       "CASE WHEN task NOT IN (" + ", ".join(f"'{t}'" for t in _THRESHOLD_TASKS) + ") THEN NULL "
       "WHEN f1 IS NULL THEN 'missing' WHEN f1 < 0.65 THEN 'low' ELSE 'high' END AS threshold_finding "
       "FROM board WHERE kind = 'classification'")
def q_findings_classification(spark, sf):
    return findings.findings_classification(findings.leaderboard(_results(spark, sf)), _THRESHOLD_TASKS)


@query("findings_overall", _results_sql(_BOARD_SQL) +
       "SELECT task, model, score, CASE WHEN task = 'regression_log_si' AND r2 < 0.3 THEN 'hard_to_predict' "
       "WHEN task = 'classification_si_8' AND f1 >= 0.8 THEN 'identifies_effective' END AS flag FROM board")
def q_findings_overall(spark, sf):
    return findings.findings_overall(findings.leaderboard(_results(spark, sf)),
                                     "regression_log_si", "classification_si_8")


def _md(cols: list[str]) -> str:
    parts = ["model"] + [f"coalesce(CAST(round({c}, 3) + 0.0 AS VARCHAR), 'nan')" for c in cols]
    return "'| ' || concat_ws(' | ', " + ", ".join(parts) + ") || ' |'"


@query("markdown_rows", _results_sql() +
       "SELECT task, model_order, CASE WHEN kind = 'regression' THEN " + _md(["mse", "r2", "mae"]) +
       " WHEN task IN (" + ", ".join(f"'{t}'" for t in _CURVE_TASKS) + ") THEN " +
       _md(["accuracy", "f1", "precision", "recall", "roc_auc", "pr_auc"]) + " ELSE " +
       _md(["accuracy", "f1", "precision", "recall"]) + " END AS line FROM results")
def q_markdown_rows(spark, sf):
    return findings.markdown_rows(_results(spark, sf), _CURVE_TASKS)


@query("triage", S.with_ctes(*S.logged_ctes()) +
       "SELECT id, CASE WHEN cc < 1 THEN 'dangerous' WHEN ic = 0 AND s8 = 1 THEN 'effective' "
       "WHEN ic = 1 AND s8 = 0 THEN 'ineffective' ELSE 'undetermined' END AS triage FROM ("
       "SELECT id, CAST(ic50 >= (SELECT median(ic50) FROM logged) AS INTEGER) AS ic, "
       "CAST(cc50 >= (SELECT median(cc50) FROM logged) AS INTEGER) AS cc, "
       "CAST(log_si >= log10(8) AS INTEGER) AS s8 FROM logged)")
def q_triage(spark, sf):
    df = _logged(spark, sf).select("id", "ic50", "cc50", "log_si")
    df, _ = labels.label_median(df, "ic50", "ic")
    df, _ = labels.label_median(df, "cc50", "cc")
    df = labels.label_threshold(df, "log_si", "s8", 8.0, "log10")
    return findings.triage(df, "ic", "cc", "s8").select("id", "triage")


# ---- K: chart data ------------------------------------------------------------

@query("chart_histogram", S.with_ctes(
    *S.logged_ctes(),
    "mm AS (SELECT min(log_ic50) AS lo, max(log_ic50) AS hi FROM logged)",
    "w AS (SELECT lo, CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END AS width FROM mm)",
    "b AS (SELECT CAST(least(floor((log_ic50 - w.lo) / w.width * 30.0) + 1, 30) AS INTEGER) AS bin, "
    "count(*) AS n FROM logged, w WHERE log_ic50 IS NOT NULL GROUP BY 1)") +
    "SELECT CAST(g.bin AS INTEGER) AS bin, round(w.lo + (g.bin - 1) * w.width / 30.0, 6) AS lo, "
    "round(w.lo + g.bin * w.width / 30.0, 6) AS hi, coalesce(b.n, 0) AS n "
    "FROM (SELECT range AS bin FROM range(1, 31)) g CROSS JOIN w LEFT JOIN b ON b.bin = g.bin")
def q_histogram(spark, sf):
    return round_all(chartdata.histogram(_logged(spark, sf), "log_ic50", 30), 6)


@query("chart_kde", S.with_ctes(
    *S.logged_ctes(),
    "st AS (SELECT count(log_ic50) AS n, stddev_samp(log_ic50) * pow(count(log_ic50), -0.2) AS h, "
    "min(log_ic50) AS lo, max(log_ic50) AS hi FROM logged)",
    "g AS (SELECT range AS i, (lo - 3.0 * h) + range * ((hi + 3.0 * h) - (lo - 3.0 * h)) / 99 AS x "
    "FROM st, range(0, 100))") +
    "SELECT round(g.x, 6) AS x, round(sum(exp(-0.5 * ((g.x - l.log_ic50) / st.h) * ((g.x - l.log_ic50) / st.h))) "
    "/ (st.n * st.h * sqrt(2 * pi())), 6) AS density FROM g, st, logged l WHERE l.log_ic50 IS NOT NULL "
    "GROUP BY g.x, st.n, st.h")
def q_kde(spark, sf):
    return round_all(chartdata.kde(_logged(spark, sf), "log_ic50", grid=100), 6)


def _each_log(sql: str, union: str = " UNION ALL ") -> str:
    """``sql`` for every log target, with its name in place of ``{c}``."""
    return union.join(sql.replace("{c}", c) for c in S.LOGS)


@query("chart_histogram_targets", S.with_ctes(
    *S.logged_ctes(),
    "long AS (" + _each_log("SELECT '{c}' AS feature, {c} AS v FROM logged WHERE {c} IS NOT NULL") + ")",
    "w AS (SELECT feature, min(v) AS lo, CASE WHEN max(v) > min(v) THEN max(v) - min(v) ELSE 1.0 END AS width FROM long GROUP BY 1)",
    "b AS (SELECT feature, CAST(least(floor((v - lo) / width * 30.0) + 1, 30) AS INTEGER) AS bin, count(*) AS n "
    "FROM long JOIN w USING (feature) GROUP BY 1, 2)") +
    "SELECT w.feature, CAST(g.bin AS INTEGER) AS bin, round(w.lo + (g.bin - 1) * w.width / 30.0, 6) AS lo, "
    "round(w.lo + g.bin * w.width / 30.0, 6) AS hi, coalesce(b.n, 0) AS n "
    "FROM (SELECT range AS bin FROM range(1, 31)) g CROSS JOIN w LEFT JOIN b ON b.bin = g.bin AND b.feature = w.feature")
def q_histogram_targets(spark, sf):
    return round_all(chartdata.histograms(_logged(spark, sf), S.LOGS, 30), 6)


@query("chart_kde_targets", S.with_ctes(
    *S.logged_ctes(),
    "long AS (" + _each_log("SELECT '{c}' AS feature, {c} AS v FROM logged WHERE {c} IS NOT NULL") + ")",
    "st AS (SELECT feature, count(v) AS n, stddev_samp(v) * pow(count(v), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1)",
    "g AS (SELECT feature, n, h, (lo - 3.0 * h) + range * ((hi + 3.0 * h) - (lo - 3.0 * h)) / 99 AS x FROM st, range(0, 100))") +
    "SELECT g.feature, round(g.x, 6) AS x, round(sum(exp(-0.5 * ((g.x - l.v) / g.h) * ((g.x - l.v) / g.h))) "
    "/ (g.n * g.h * sqrt(2 * pi())), 6) AS density FROM g JOIN long l USING (feature) GROUP BY g.feature, g.x, g.n, g.h")
def q_kde_targets(spark, sf):
    return round_all(chartdata.densities(_logged(spark, sf), S.LOGS, grid=100), 6)


_BOX = [*TARGETS, *S.LOGS]


@query("chart_box", S.with_ctes(*S.logged_ctes(), S.fences_cte("logged", _BOX, "bf")) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.25), 6) AS q1, round(median({c}), 6) AS median, "
    f"round(quantile_cont({c}, 0.75), 6) AS q3, round(min({c}) FILTER (WHERE {c} >= (SELECT {c}_lo FROM bf)), 6) "
    f"AS whisker_lo, round(max({c}) FILTER (WHERE {c} <= (SELECT {c}_hi FROM bf)), 6) AS whisker_hi, "
    f"count(*) FILTER (WHERE {c} < (SELECT {c}_lo FROM bf) OR {c} > (SELECT {c}_hi FROM bf)) AS n_fliers "
    f"FROM logged" for c in _BOX))
def q_box(spark, sf):
    return round_all(chartdata.box_summary(_logged(spark, sf), _BOX), 6)


@query("chart_box_fliers", S.with_ctes(*S.logged_ctes(), S.fences_cte("logged", _BOX, "bf")) + " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, round({c}, 6) AS value FROM logged, bf "
    f"WHERE {c} < {c}_lo OR {c} > {c}_hi" for c in _BOX))
def q_box_fliers(spark, sf):
    return round_all(chartdata.box_fliers(_logged(spark, sf), "id", _BOX), 6)


@query("chart_scatter", _preds_sql(["regression_log_ic50"]) +
       "SELECT id, round(y, 6) AS y, round(p, 6) AS p FROM preds WHERE split = 'test' AND model = 'rule_price'")
def q_scatter(spark, sf):
    p = _preds(spark, sf, ["regression_log_ic50"]).where("split = 'test' AND model = 'rule_price'")
    return round_all(chartdata.scatter_points(p, "id", "y", "p"), 6)


@query("chart_scatter_range", _preds_sql(["regression_log_ic50"]) +
       "SELECT round(least(min(y), min(p)), 6) AS lo, round(greatest(max(y), max(p)), 6) AS hi "
       "FROM preds WHERE split = 'test' AND model = 'rule_price'")
def q_scatter_range(spark, sf):
    p = _preds(spark, sf, ["regression_log_ic50"]).where("split = 'test' AND model = 'rule_price'")
    return round_all(chartdata.identity_range(p, "y", "p"), 6)


@query("corr_matrix_wide", "WITH e AS (SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) +
       " FROM embeddings), w AS (SELECT e.*, CAST(s_acctbal AS DOUBLE) AS e64, CAST(c_acctbal AS DOUBLE) AS e65 FROM e "
       "LEFT JOIN supplier ON s_suppkey = vec_id LEFT JOIN customer ON c_custkey = vec_id * 4), "
       "l AS (UNPIVOT w ON " + ", ".join(f"e{i}" for i in range(66)) + " INTO NAME feature VALUE v), "
       "p AS (SELECT vec_id, feature, CAST(substr(feature, 2) AS INTEGER) AS pos, v FROM l) "
       "SELECT x.feature AS a, y.feature AS b, x.pos AS pos_a, y.pos AS pos_b, round(abs(corr(x.v, y.v)), 6) AS r "
       "FROM p x JOIN p y ON x.vec_id = y.vec_id AND x.pos < y.pos GROUP BY ALL")
def q_corr_matrix_wide(spark, sf):
    """66 columns, two of them with NULLs in different rows: the components of the embeddings and two joined balances."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("sk"), F.col("s_acctbal").cast("double").alias("e64"))
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("ck"), F.col("c_acctbal").cast("double").alias("e65"))
    wide = e.join(s, F.col("sk") == F.col("vec_id"), "left").join(c, F.col("ck") == F.col("vec_id") * 4, "left")
    return select.corr_matrix(wide, [f"e{i}" for i in range(66)]).withColumn("r", rnd("r", 6))


_KEYED = ("WITH k AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 7 = 1 THEN '' ELSE o_orderpriority END AS k, "
          "o_totalprice > 150000 AS big, CAST(o_totalprice AS DOUBLE) AS v FROM orders) ")


def _keyed_orders(spark, sf) -> DataFrame:
    o, m = spark.read.parquet(f"{sf}/orders.parquet"), F.col("o_custkey") % 7
    return o.select("o_orderkey", F.when(m == 0, F.lit(None)).when(m == 1, F.lit("")).otherwise(F.col("o_orderpriority")).alias("k"),
                    (F.col("o_totalprice") > 150000).alias("big"), F.col("o_totalprice").cast("double").alias("v"))


@query("quantile_by_string_key", _KEYED + "SELECT k, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS q2, "
       "round(quantile_cont(v, 0.75), 6) AS q3 FROM k GROUP BY k")
def q_quantile_by_string_key(spark, sf):
    """Exact quartiles per string key, NULL and '' being keys of their own."""
    from tabmill.functions.quantiles import exact_quantiles
    qs = exact_quantiles(_keyed_orders(spark, sf), ["k"], "v", [0.25, 0.5, 0.75])
    rows = [(g[0], q[0.25], q[0.5], q[0.75]) for g, q in qs.items()]
    return round_all(spark.createDataFrame(rows, "k string, q1 double, q2 double, q3 double"), 6)


@query("split_stratified_bool", _KEYED +
       f", u AS (SELECT o_orderkey, big, {S.hash_u('o_orderkey')} AS u FROM k), "
       "n AS (SELECT big, round(0.2 * count(*)) AS t FROM u GROUP BY big), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY big ORDER BY u) AS rn FROM u) "
       "SELECT o_orderkey, big, CASE WHEN rn <= t THEN 'test' ELSE 'train' END AS split FROM r JOIN n USING (big)")
def q_split_stratified_bool(spark, sf):
    return split.split_stratified(_keyed_orders(spark, sf).select("o_orderkey", "big"), "o_orderkey", "big")


_F1_SQL = ("SELECT task, model, split, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM ("
           "SELECT task, model, split, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp, "
           "count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn FROM preds GROUP BY task, model, split)")


@query("f1_by_split", _preds_sql(["classification_ic50_median", "classification_si_8"]) + _F1_SQL)
def q_f1_by_split(spark, sf):
    """F1 of class 1 on the train and the test split: the overfit check of the classification tasks."""
    p = _preds(spark, sf, ["classification_ic50_median", "classification_si_8"])
    m = evaluate.metrics_classification(p, "y", "yhat", ["task", "model", "split"])
    return round_all(m.select("task", "model", "split", "f1"), 6)


@query("rename_map", S.with_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS original, '{_RENAMED[c]}' AS new, {i} AS position, count({c}) AS n_values FROM assay"
    for i, c in enumerate(S.ASSAY_COLS) if c not in TARGETS))
def q_rename_map(spark, sf):
    """The positional rename's map, with the values found under each new name."""
    df, names = clean.rename_features(P.assay_raw(spark, sf), keep=TARGETS)
    new = [c for c in df.columns if c not in TARGETS]
    counts = df.agg(*[F.count(c).alias(c) for c in new]).unpivot([], new, "new", "n_values")
    return names.join(counts, "new").select("original", "new", "position", "n_values")


# ---- G5: SMOTE ------------------------------------------------------------------

SMOTE_FEATS = list(FEATURES)
SMOTE_K = 5


def _smote_input(spark, sf) -> DataFrame:
    """Train rows of the SI >= 8 task, features robust-scaled with exact
    train medians and IQRs, so distances are exact in any engine."""
    from tabmill.functions.quantiles import column_quantiles
    df = _logged(spark, sf).select("id", "log_si", *SMOTE_FEATS)
    df = labels.label_threshold(df, "log_si", "label", 8.0, "log10")
    train = split.split_random(df, "id").where("split = 'train'")
    qs = column_quantiles(train, SMOTE_FEATS, [0.25, 0.5, 0.75])
    out = {}
    for c in SMOTE_FEATS:
        iqr = qs[c][0.75] - qs[c][0.25]
        out[c] = (F.col(c).cast("double") - F.lit(qs[c][0.5])) / F.lit(iqr if iqr else 1.0)
    return train.withColumns(out).select("id", "label", *SMOTE_FEATS)


def _smote_sql(*more: str) -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_r"
                   for c in SMOTE_FEATS)
    z = ", ".join(f"(CAST(t.{c} AS DOUBLE) - q.{c}_m) / CASE WHEN q.{c}_r = 0 THEN 1.0 ELSE q.{c}_r END AS {c}"
                  for c in SMOTE_FEATS)
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMOTE_FEATS)
    return S.with_ctes(
        *S.logged_ctes(),
        f"tr AS (SELECT id, CAST(log_si >= log10(8) AS INTEGER) AS label, {', '.join(SMOTE_FEATS)} FROM logged "
        f"WHERE NOT ({S.hash_u('id')} < 0.2))",
        f"q AS (SELECT {qs} FROM tr)",
        f"sc AS (SELECT t.id, t.label, {z} FROM tr t, q)",
        "cls AS (SELECT label, count(*) AS n FROM sc GROUP BY label)",
        "mn AS (SELECT label AS minority, n AS n_min, (SELECT max(n) FROM cls) AS n_maj FROM cls "
        "ORDER BY n, label LIMIT 1)",
        "mins AS (SELECT sc.* FROM sc, mn WHERE sc.label = mn.minority)",
        f"pairs AS (SELECT a.id, b.id AS nb_id, {dist} AS dist FROM mins a JOIN mins b ON a.id <> b.id)",
        f"nbrs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nb_id) AS nb_rank "
        f"FROM pairs) WHERE nb_rank <= (SELECT least({SMOTE_K}, n_min - 1) FROM mn))",
        *more)


@query("smote_neighbors", _smote_sql() +
       "SELECT id, CAST(nb_rank AS INTEGER) AS nb_rank, nb_id, round(dist, 6) AS dist FROM nbrs")
def q_smote_neighbors(spark, sf):
    from tabmill.operators.balance import knn_self
    df = _smote_input(spark, sf)
    counts = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    minority = min(counts, key=lambda c: (counts[c], c))
    mins = df.where(F.col("label") == minority)
    nb = knn_self(mins, "id", SMOTE_FEATS, min(SMOTE_K, counts[minority] - 1))
    return nb.select("id", F.col("nb_rank").cast("int").alias("nb_rank"), "nb_id", rnd("dist", 6).alias("dist"))


_SYN = ", ".join(
    f"round(m.{c} + g.gap * (n.{c} - m.{c}), 6) AS {c}" for c in SMOTE_FEATS)


@query("smote_rows", _smote_sql(
    "plan AS (SELECT (n_maj - n_min) // n_min AS base, (n_maj - n_min) % n_min AS extra, "
    f"least({SMOTE_K}, n_min - 1) AS k FROM mn)",
    f"ranked AS (SELECT id, row_number() OVER (ORDER BY {S.hash_u('id', 42, 'smote')}) AS r FROM mins)",
    "cp AS (SELECT r.id, plan.base + CASE WHEN r.r <= plan.extra THEN 1 ELSE 0 END AS n, plan.k FROM ranked r, plan)",
    "g AS (SELECT id, copy, k, "
    "CAST(floor((CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':42:nb:' || CAST(copy AS VARCHAR)), 1, 15)) "
    "AS BIGINT) AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE)) * k) + 1 AS INTEGER) AS pick, "
    "CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':42:gap:' || CAST(copy AS VARCHAR)), 1, 15)) "
    "AS BIGINT) AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS gap "
    "FROM (SELECT id, k, unnest(range(n)) AS copy FROM cp WHERE n > 0))") +
    "SELECT g.id AS source_id, CAST(g.copy AS INTEGER) AS copy, b.nb_id AS neighbor_id, round(g.gap, 9) AS gap, "
    + ", ".join(f"round(m.{c} + g.gap * (n.{c} - m.{c}), 6) AS {c}" for c in SMOTE_FEATS) +
    " FROM g JOIN nbrs b ON b.id = g.id AND b.nb_rank = g.pick JOIN mins m ON m.id = g.id "
    "JOIN mins n ON n.id = b.nb_id")
def q_smote_rows(spark, sf):
    from tabmill.operators.balance import smote
    syn, _ = smote(_smote_input(spark, sf), "id", SMOTE_FEATS, "label", k=SMOTE_K)
    return syn.select("source_id", F.col("copy").cast("int").alias("copy"), "neighbor_id",
                      rnd("gap", 9).alias("gap"), *[rnd(c, 6).alias(c) for c in SMOTE_FEATS])


# ---- H / I: Spark ML models and tuning (rows-only checks) -----------------------

def _prepared(spark, sf, task_name: str, resample: bool = False, fit_on: str = "train"):
    from tabmill.plans import study
    pre = P.preprocess(P.assay_raw(spark, sf), ASSAY_SPEC, cut_lineage=True, fit_on=fit_on)
    return pre, study.prepare(pre, TASK_BY_NAME[task_name], n_folds=3, resample=resample)


def _fit_query(model: str, task_name: str):
    def run(spark, sf):
        from tabmill.plans import models as M
        task = TASK_BY_NAME[task_name]
        _, prep = _prepared(spark, sf, task_name)
        est = M.build(model, task.kind, M.DEFAULTS[model], prep.n_train)
        fitted = est.fit(prep.train)
        out = M.predict(fitted, prep.test, task.kind)
        cols = ["id", "y", F.col("prediction").cast("double").alias("prediction")]
        if task.kind == "classification":
            cols.append(F.col("p").alias("probability"))
        return out.select(*cols)
    return run


for _m, _key in [("RF", "fit_rf_reg"), ("XGB", "fit_xgb_reg"), ("LGB", "fit_lgb_reg"),
                 ("GB", "fit_gb_reg")]:
    query(_key)(_fit_query(_m, "regression_log_ic50"))
for _m, _key in [("RF", "fit_rf_clf"), ("XGB", "fit_xgb_clf"), ("LGB", "fit_lgb_clf"),
                 ("GB", "fit_gb_clf"), ("LR", "fit_logistic")]:
    query(_key)(_fit_query(_m, "classification_ic50_median"))


@query("fit_linear", _preds_sql(["regression_log_ic50"]) +
       "SELECT round(regr_slope(y, n_lines), 6) + 0.0 AS slope, "
       "round(regr_intercept(y, n_lines), 6) + 0.0 AS intercept FROM t0 WHERE split = 'train'")
def q_fit_linear(spark, sf):
    """Ordinary least squares through Spark ML's normal-equation solver,
    one feature so that SQL's regr_slope / regr_intercept check it."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    t = T.task_frame(_logged(spark, sf), TASK_BY_NAME["regression_log_ic50"]).where("split = 'train'")
    v = VectorAssembler(inputCols=["n_lines"], outputCol="features").transform(t)
    m = LinearRegression(featuresCol="features", labelCol="y", solver="normal", regParam=0.0).fit(v)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))],
                                 "slope double, intercept double").select(
        rnd("slope", 6).alias("slope"), rnd("intercept", 6).alias("intercept"))


def _first_tree(task_name: str, params) -> None:
    """Registers the first boosting tree on a task's train split: splits with their gains, leaves with their values."""
    from tabmill.plans import tree_sql
    task = TASK_BY_NAME[task_name]

    def run(spark, sf):
        from tabmill.plans import models as M
        from tabmill.trees.boosting import fit_boosting
        logged = _logged(spark, sf)
        rows = T.task_frame(logged, task).where("split = 'train'").select("id", "y")
        train = materialize(rows.join(logged.select("id", *tree_sql.FEATURES), "id"), "tree-train")
        fits, _ = fit_boosting([(M.assemble(train, tree_sql.FEATURES), None)], [(0, params)], task.kind)
        rows = [(n, None if f is None else tree_sql.FEATURES[f], c, g, v) for n, f, c, g, v in fits[0].nodes(0)]
        out = spark.createDataFrame(rows, "node long, feature string, threshold double, gain double, value double")
        return out.select("node", "feature", "threshold", rnd("gain", 4).alias("gain"), rnd("value", 8).alias("value"))

    key = "boost_tree_leafwise" if params.leaves else "boost_tree_regularised"
    query(f"{key}_{'reg' if task.kind == 'regression' else 'clf'}",
          _preds_sql([task_name], *tree_sql.first_tree_ctes(task.kind, params)) + tree_sql.first_tree_sql(params))(run)


for _task in ("regression_log_ic50", "classification_ic50_median"):
    _first_tree(_task, BoostParams(rounds=1, rate=0.3, depth=2, l2=7.5, l1=0.6, min_hessian=1.0))
    _first_tree(_task, BoostParams(rounds=1, rate=0.1, depth=0, leaves=4, min_rows=20, min_hessian=1e-3))


def _vote_query(task_name: str):
    def run(spark, sf):
        from tabmill.plans import models as M
        task = TASK_BY_NAME[task_name]
        _, prep = _prepared(spark, sf, task_name)
        members = M.fit_vote(prep.train, task.kind, params=M.DEFAULTS, n_train=prep.n_train)
        out = M.predict_vote(members, prep.test, task.kind)
        cols = ["id", "y", "p"] + [f"p_{m.lower()}" for m in M.VOTE_MEMBERS]
        if task.kind == "classification":
            cols.append("yhat")
        return out.select(*cols)
    return run


query("vote_reg")(_vote_query("regression_log_ic50"))
query("vote_clf")(_vote_query("classification_ic50_median"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    from tabmill.plans import models as M
    _, prep = _prepared(spark, sf, "regression_log_ic50")
    rf = M.build("RF", "regression", M.DEFAULTS["RF"]).fit(prep.train)
    imp = spark.createDataFrame(M.importances(rf, prep.features), "feature string, importance double")
    return evaluate.top_k(imp, "importance", 10, "feature")


@query("tune_model")
def q_tune_model(spark, sf):
    from tabmill.plans import tune as TU
    _, prep = _prepared(spark, sf, "regression_log_ic50")
    # two draws of the study's own space over three folds; the study's budget is 50 draws over five
    draws = TU.draws_for("RF", "regression", False, 2)
    _, _, trials = TU.tune(prep.train, "RF", "regression", draws, prep.folds, "mse", prep.n_train)
    return spark.createDataFrame(trials, "trial int, params string, score double")


@query("smote_train", _smote_sql() + "SELECT CAST(label AS DOUBLE) AS y, (SELECT n_maj FROM mn) AS n FROM cls")
def q_smote_train(spark, sf):
    """Class counts of a classification train split after SMOTE (the
    classes come out equal)."""
    _, prep = _prepared(spark, sf, "classification_si_8", resample=True, fit_on="all")
    return prep.train.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


# ---- C6 / C7 / B10 / L7 / A2: two-stage profile and the processed table ----------

_ALL_DTYPES = ["bigint", "double", "int"]


def _profile_compare_df(spark, sf) -> DataFrame:
    pre = P.preprocess(P.assay_raw(spark, sf), ASSAY_SPEC, cut_lineage=True, profile_before=True, fit_on="all")
    before = pre.info_before
    after = profile.profile_info(pre.table, "after", TARGETS + S.LOGS, _ALL_DTYPES)
    return profile.profile_compare(before, after)


def _after_info_sql() -> str:
    outl = ", ".join(f"(SELECT count(*) FROM logged, af WHERE {c} < {c}_lo OR {c} > {c}_hi) AS outliers_{c}"
                     for c in TARGETS + S.LOGS)
    tmiss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["id"] + TARGETS + S.LOGS)
    return ("SELECT 'after' AS stage, count(*) AS rows, CAST(7 + (SELECT count(*) FROM kept) AS BIGINT) AS columns, "
            f"{tmiss} + (SELECT count(*) FROM long WHERE v IS NULL AND feature IN (SELECT feature FROM kept)) "
            "AS missing_values, CAST(1 AS BIGINT) AS dtype_bigint, "
            "CAST(6 + (SELECT count(*) FROM kept) AS BIGINT) AS dtype_double, CAST(0 AS BIGINT) AS dtype_int, "
            f"{outl} FROM logged")


def _before_info_sql() -> str:
    nulls = ", ".join(f"CAST(NULL AS BIGINT) AS outliers_{c}" for c in S.LOGS)
    head, _, tail = _info_sql("dedup", "before", S.ASSAY_COLS, TARGETS, _RAW_DTYPES,
                              _ALL_DTYPES).rpartition(" FROM dedup")
    return f"{head}, {nulls} FROM dedup{tail}"


_COMPARE_CTES = (*S.selected_ctes(), S.fences_cte("dedup", TARGETS, "before_f"),
                 S.fences_cte("logged", TARGETS + S.LOGS, "af"))


@query("profile_compare", S.with_ctes(*_COMPARE_CTES) + _before_info_sql() + " UNION ALL " + _after_info_sql())
def q_profile_compare(spark, sf):
    return _profile_compare_df(spark, sf)


@query("profile_filter", S.with_ctes(*_COMPARE_CTES, "info AS (" + _before_info_sql() + " UNION ALL "
                                     + _after_info_sql() + ")") + "SELECT * FROM info WHERE stage = 'before'")
def q_profile_filter(spark, sf):
    return _profile_compare_df(spark, sf).where(F.col("stage") == "before")


@query("dataset_summary", S.with_ctes(*_COMPARE_CTES, "info AS (" + _before_info_sql() + " UNION ALL "
                                      + _after_info_sql() + ")") +
       "SELECT stage, printf('%d rows, %d columns, %d missing cells', rows, columns, missing_values) AS line "
       "FROM info WHERE stage = 'before'")
def q_dataset_summary(spark, sf):
    return findings.dataset_summary(_profile_compare_df(spark, sf), "before")


def _after_describe_sql() -> str:
    parts = []
    for c in ["id"] + FEATURES + TARGETS + S.LOGS:
        q = _describe_sql("logged", [c], "'after' AS stage, ")
        if c in FEATURES:
            q += f" HAVING '{c}' IN (SELECT feature FROM kept)"
        parts.append(q)
    return " UNION ALL ".join(parts)


@query("profile_compare_stats", S.with_ctes(*S.selected_ctes()) +
       _describe_sql("dedup", S.ASSAY_COLS, "'before' AS stage, ") + " UNION ALL " + _after_describe_sql())
def q_profile_compare_stats(spark, sf):
    pre = P.preprocess(P.assay_raw(spark, sf), ASSAY_SPEC, cut_lineage=True, profile_before=True, fit_on="all")
    return profile.profile_compare_stats(profile.describe_table(pre.deduped),
                                         profile.describe_table(pre.table))


@query("load_processed", S.with_ctes(
    *S.selected_ctes(),
    "pl AS (UNPIVOT (SELECT id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES + TARGETS + S.LOGS)
    + " FROM logged) ON " + ", ".join(FEATURES + TARGETS + S.LOGS) + " INTO NAME feature VALUE value)") +
    "SELECT id, feature, round(value, 6) + 0.0 AS value FROM pl WHERE feature IN (SELECT feature FROM kept) "
    "OR feature IN (" + ", ".join(f"'{c}'" for c in TARGETS + S.LOGS) + ")")
def q_load_processed(spark, sf):
    """Write the processed table as CSV with a header, read it back with its
    schema (no inference pass), and list its cells."""
    import uuid
    from tabmill.session import ensure_checkpoint_dir
    from tabmill.sources.tables import load_table, write_table
    pre = P.preprocess(P.assay_raw(spark, sf), ASSAY_SPEC, cut_lineage=True, fit_on="all")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabmill/processed-{uuid.uuid4().hex}"
    write_table(pre.table, path, fmt="csv")
    back = load_table(spark, path, fmt="csv", schema=pre.table.schema)
    cols = [c for c in back.columns if c != "id"]
    long = back.unpivot(["id"], cols, "feature", "value")
    return long.select("id", "feature", rnd("value", 6).alias("value"))


@query("vote_averaging", _preds_sql(["classification_ic50_median"]) +
       "SELECT id, split, y, round(avg(p), 9) AS p, CAST(avg(p) > 0.5 AS INTEGER) AS yhat "
       "FROM preds GROUP BY id, split, y")
def q_vote_averaging(spark, sf):
    """Soft vote of the rule scorers: mean positive score per row, class 1
    above 0.5 (the averaging step of the voting ensembles)."""
    from tabmill.plans import models as M
    p = _preds(spark, sf, ["classification_ic50_median"])
    v = M.vote_long(p, ["id", "split", "y"], "classification")
    return v.select("id", "split", "y", rnd("p", 9).alias("p"), "yhat")


# ---- one study task end to end (rows-only) -------------------------------------

def _task_query(task_name: str, resample: bool):
    def run(spark, sf):
        from tabmill.plans import study
        pre = P.preprocess(P.assay_raw(spark, sf), ASSAY_SPEC, cut_lineage=True)
        tr = study.run_task(pre, TASK_BY_NAME[task_name], n_draws=3, n_folds=3, light=True,
                            resample=resample)
        return tr.results
    return run


query("task_results_regression")(_task_query("regression_log_ic50", False))
query("task_results_classification")(_task_query("classification_ic50_median", True))
