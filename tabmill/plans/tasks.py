"""The seven modelling tasks of the study and a set of rule scorers.

A task is a target (a log target for regression, a binary label for
classification) plus a split. Rule scorers are fixed formulas fit on the
train split with exact statistics (medians, quartiles); they give every
evaluation, leaderboard and findings step an exact SQL counterpart, while
the Spark ML models (``plans.models``) go through the same evaluation code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.operators import evaluate, labels, split
from tabmill.sources.assay import ASSAY_SPEC


@dataclass(frozen=True)
class Task:
    name: str
    kind: str                 # "regression" | "classification"
    target: str               # column the label / value comes from
    rule: str = ""            # "median_ge" | "median_gt" | "threshold"
    threshold: float = 0.0
    scale: str = "raw"
    stratify: bool = False
    curves: bool = True       # ROC AUC / average precision reported
    metric: str = "r2"        # metric that picks the best single model
    n_draws: int = 50         # search budget


# fixed values: the study's tasks, in report order
TASKS = [
    Task("regression_log_ic50", "regression", "log_ic50", metric="r2"),
    Task("regression_log_cc50", "regression", "log_cc50", metric="r2"),
    Task("regression_log_si", "regression", "log_si", metric="r2"),
    Task("classification_ic50_median", "classification", "ic50", "median_ge",
         stratify=True, metric="f1"),
    Task("classification_cc50_median", "classification", "cc50", "median_ge",
         stratify=True, metric="f1"),
    Task("classification_si_median", "classification", "si", "median_gt",
         stratify=True, metric="f1"),
    Task("classification_si_8", "classification", "log_si", "threshold", threshold=8.0,
         scale="log10", curves=False, metric="accuracy", n_draws=20),
]
TASK_BY_NAME = {t.name: t for t in TASKS}

# rule scorers: (name, feature) for classification, (name, kind) for regression
CLF_RULES = [("rule_sum_price", "sum_price"), ("rule_n_lines", "n_lines"),
             ("rule_acctbal", "acctbal")]
REG_RULES = ["rule_price", "train_median", "train_mean"]
RULE_FEATURES = ["sum_price", "avg_disc", "n_lines", "acctbal"]


def task_frame(logged: DataFrame, task: Task, id_col: str = ASSAY_SPEC.id) -> DataFrame:
    """(id, y, split, rule features...) for one task."""
    df = logged.select(id_col, task.target, *[c for c in RULE_FEATURES if c != task.target])
    if task.kind == "regression":
        df = df.withColumn("y", F.col(task.target).cast("double"))
    elif task.rule in ("median_ge", "median_gt"):
        df, _ = labels.label_median(df, task.target, "y", strict=task.rule == "median_gt")
    else:
        df = labels.label_threshold(df, task.target, "y", task.threshold, task.scale)
    if task.stratify:
        df = split.split_stratified(df, id_col, "y")
    else:
        df = split.split_random(df, id_col)
    return df


def softsign_score(c: str, center: float, spread: float):
    """A score in (0, 1), increasing in c: 0.5 + 0.5 z / (1 + |z|) with
    z = (c - center) / spread. Only + - * / and abs, so every engine gives
    the same bits."""
    z = (F.col(c).cast("double") - F.lit(center)) / F.lit(spread if spread else 1.0)
    return F.lit(0.5) + F.lit(0.5) * z / (F.lit(1.0) + F.abs(z))


def results_for(preds: DataFrame, tasks: list[Task], digits: int = 3) -> DataFrame:
    """Results table (task, kind, model, model_order, n, mse, r2, mae,
    accuracy, precision, recall, f1, roc_auc, pr_auc) on the test split,
    rounded; regression rows leave the classification columns NULL and
    the other way round."""
    from tabmill.functions.exprs import rnd
    test = preds.where(F.col("split") == "test")
    reg_names = [t.name for t in tasks if t.kind == "regression"]
    clf_names = [t.name for t in tasks if t.kind == "classification"]
    curve_names = [t.name for t in tasks if t.kind == "classification" and t.curves]
    key = ["task", "model", "model_order"]
    cols = ["mse", "r2", "mae", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    frames = []
    if reg_names:
        r = evaluate.metrics_regression(test.where(F.col("task").isin(reg_names)), "y", "p", key)
        frames.append(r.select(*key, F.lit("regression").alias("kind"), "n", "mse", "r2", "mae",
                               *[F.lit(None).cast("double").alias(c) for c in cols[3:]]))
    if clf_names:
        ctest = test.where(F.col("task").isin(clf_names))
        m = evaluate.metrics_classification(ctest, "y", "yhat", key)
        cm = evaluate.curve_metrics(ctest.where(F.col("task").isin(curve_names or [""])),
                                    "y", "p", key)
        m = m.join(cm, key, "left")
        frames.append(m.select(*key, F.lit("classification").alias("kind"), "n",
                               *[F.lit(None).cast("double").alias(c) for c in cols[:3]],
                               "accuracy", "precision", "recall", "f1", "roc_auc",
                               F.col("average_precision").alias("pr_auc")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    order = F.create_map(*[x for t in tasks
                           for x in (F.lit(t.name), F.lit(TASKS.index(t) if t in TASKS else 0))])
    return out.select("task", "kind", "model", "model_order", "n",
                      *[rnd(c, digits).alias(c) for c in cols],
                      order[F.col("task")].alias("task_order"))


def _task_columns(logged: DataFrame, tasks: list[Task], id_col: str) -> tuple[DataFrame, list]:
    """A written row per id with the rule features and every task's y (``y0``, ``y1`` ...), and per task the condition of a test row.

    The label medians of all median tasks are one exact-quantile fit, and
    the stratified cuts of all stratified tasks one order-statistic fit with a
    column for each (task, class), instead of a pair of jobs per task."""
    from tabmill.functions.exprs import hash_uniform
    from tabmill.functions.quantiles import column_kth, column_medians
    from tabmill.session import materialize

    med_cols = sorted({t.target for t in tasks if t.rule in ("median_ge", "median_gt")})
    meds = column_medians(logged, med_cols) if med_cols else {}
    ys = []
    for t in tasks:
        c = F.col(t.target)
        if t.kind == "regression":
            y = c.cast("double")
        elif t.rule == "median_ge":
            y = (c >= F.lit(meds[t.target])).cast("double")
        elif t.rule == "median_gt":
            y = (c > F.lit(meds[t.target])).cast("double")
        else:
            y = (c >= F.lit(labels.threshold_value(t.threshold, t.scale))).cast("double")
        ys.append(y)
    # every fit and every metric job reads this frame: the hash is taken once
    base = materialize(logged.select(
        id_col, *[F.col(f).cast("double").alias(f) for f in RULE_FEATURES], *[y.alias(f"y{i}") for i, y in enumerate(ys)],
        hash_uniform(id_col, split.SEED).alias("__u")), "task_frames")
    u = F.col("__u")
    cells = {f"{i}_{cls}": (i, cls) for i, t in enumerate(tasks) if t.stratify for cls in (0, 1)}
    tests = [u < F.lit(split.TEST_FRACTION) if not t.stratify else F.lit(False) for t in tasks]
    if cells:
        hashes = base.select(*[F.when(F.col(f"y{i}") == cls, u).alias(name) for name, (i, cls) in cells.items()])

        def last(n: int) -> list[int]:
            k = int(math.floor(split.TEST_FRACTION * n + 0.5))
            return [k - 1] if k > 0 else []
        kth, _ = column_kth(hashes, list(cells), last)
        for (name,), found in kth.items():
            i, cls = cells[name]
            for tau in found.values():
                tests[i] = tests[i] | ((F.col(f"y{i}") == cls) & (u <= F.lit(tau)))
    return base, tests


def _task_rows(base: DataFrame, tests: list, tasks: list[Task], id_col: str) -> DataFrame:
    rows = [F.struct(F.lit(t.name).alias("task"), F.col(f"y{i}").alias("y"), F.when(tests[i], "test").otherwise("train").alias("split"))
            for i, t in enumerate(tasks)]
    return (base.select(id_col, *RULE_FEATURES, F.explode(F.array(*rows)).alias("__t"))
            .select("__t.task", id_col, "__t.y", *RULE_FEATURES, "__t.split"))


def all_task_frames(logged: DataFrame, tasks: list[Task], id_col: str = ASSAY_SPEC.id) -> DataFrame:
    """(task, id, y, rule features, split) for every task at once."""
    return _task_rows(*_task_columns(logged, tasks, id_col), tasks, id_col)


def all_rule_predictions(logged: DataFrame, tasks: list[Task], id_col: str = ASSAY_SPEC.id) -> DataFrame:
    """Rule predictions for every task; the train-split statistics of all
    tasks come from one exact-quantile fit with a column for each task and
    feature, and one row of means."""
    from tabmill.functions.quantiles import column_quantiles
    base, tests = _task_columns(logged, tasks, id_col)
    frame = _task_rows(base, tests, tasks, id_col)
    fitted = {}  # of every (task, feature): its column of train values
    for i, t in enumerate(tasks):
        for f in ("y",) if t.kind == "regression" else (f for _, f in CLF_RULES):
            fitted[t.name, f] = F.when(~F.coalesce(tests[i], F.lit(False)), F.col(f"y{i}" if f == "y" else f))
    names = {key: f"f{i}" for i, key in enumerate(fitted)}
    train = base.select(*[c.alias(names[key]) for key, c in fitted.items()])
    found = column_quantiles(train, list(names.values()), [0.25, 0.5, 0.75])
    qs = {key: found[name] for key, name in names.items()}
    means = {}
    reg = [t.name for t in tasks if t.kind == "regression"]
    if reg:
        row = train.agg(*[F.avg(names[name, "y"]).alias(names[name, "y"]) for name in reg]).first()
        means = {name: row[names[name, "y"]] for name in reg}
    # the rules of a row's task as an array, so one scan serves all tasks and rules
    scored = F.lit(None)
    for t in tasks:
        if t.kind == "regression":
            preds = {
                "rule_price": F.log(F.lit(1.0) + F.col("sum_price") * (F.lit(1.0) - F.col("avg_disc"))),
                "train_median": F.lit(qs[(t.name, "y")][0.5]),
                "train_mean": F.lit(means[t.name]),
            }
            rules = [(name, preds[name].cast("double"), F.lit(None).cast("int")) for name in REG_RULES]
        else:
            rules = []
            for name, f in CLF_RULES:
                q = qs[(t.name, f)]
                p = softsign_score(f, q[0.5], q[0.75] - q[0.25])
                rules.append((name, p, (p >= F.lit(0.5)).cast("int")))
        cells = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(i).alias("model_order"), p.alias("p"), yhat.alias("yhat"))
                          for i, (name, p, yhat) in enumerate(rules)])
        scored = F.when(F.col("task") == t.name, cells).otherwise(scored)
    return (frame.select("task", "split", id_col, "y", F.explode(scored).alias("__s"))
            .select("task", "__s.model", "__s.model_order", "split", id_col, "y", "__s.p", "__s.yhat"))
