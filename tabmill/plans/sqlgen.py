"""SQL text for the DuckDB oracle: the same stages as the Spark pipeline,
written as a chain of CTEs over the registered test tables."""

from __future__ import annotations

from tabmill.sources.assay import ASSAY_SQL, FEATURES, TARGETS

ASSAY_COLS = ["id", *TARGETS, *FEATURES]
NUMERIC_NO_ID = [*TARGETS, *FEATURES]
LOGS = [f"log_{t}" for t in TARGETS]


def with_ctes(*ctes: str) -> str:
    """WITH <assay CTEs>, <more CTEs>"""
    parts = [ASSAY_SQL.strip()] + [c.strip() for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n"


def rounded(cols: list[str], digits: int, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"round({p}{c}, {digits}) + 0.0 AS {c}" for c in cols)


def fences_cte(src: str, cols: list[str], name: str = "fences") -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3"
                  for c in cols)
    f = ", ".join(f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, "
                  f"{c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi" for c in cols)
    return f"{name}_q AS (SELECT {q} FROM {src}),\n{name} AS (SELECT {f} FROM {name}_q)"


DEDUP = "dedup AS (SELECT DISTINCT * FROM assay)"


def clipped_ctes() -> list[str]:
    cases = ", ".join(
        f"CASE WHEN d.{c} < f.{c}_lo THEN f.{c}_lo WHEN d.{c} > f.{c}_hi THEN f.{c}_hi "
        f"ELSE CAST(d.{c} AS DOUBLE) END AS {c}" for c in TARGETS)
    others = ", ".join(f"d.{c}" for c in FEATURES)
    return [DEDUP, fences_cte("dedup", TARGETS),
            f"clipped AS (SELECT d.id, {cases}, {others} FROM dedup d, fences f)"]


def imputed_ctes() -> list[str]:
    med = ", ".join(f"median({c}) AS {c}" for c in NUMERIC_NO_ID)
    fill = ", ".join(f"coalesce(CAST(c.{c} AS DOUBLE), m.{c}) AS {c}" for c in NUMERIC_NO_ID)
    return clipped_ctes() + [f"medians AS (SELECT {med} FROM clipped)",
                             f"imputed AS (SELECT c.id, {fill} FROM clipped c, medians m)"]


def floored_ctes() -> list[str]:
    cnt = ", ".join(f"count(*) FILTER (WHERE {c} <= 0) AS {c}" for c in TARGETS)
    fix = ", ".join(f"CASE WHEN n.{c} > 0 AND i.{c} < 1e-6 THEN 1e-6 ELSE i.{c} END AS {c}"
                    for c in TARGETS)
    others = ", ".join(f"i.{c}" for c in FEATURES)
    return imputed_ctes() + [f"nonpos AS (SELECT {cnt} FROM imputed)",
                             f"floored AS (SELECT i.id, {fix}, {others} FROM imputed i, nonpos n)"]


def logged_ctes() -> list[str]:
    logs = ", ".join(f"ln(1 + {c}) AS log_{c}" for c in TARGETS)
    return floored_ctes() + [f"logged AS (SELECT *, {logs} FROM floored)"]


def corr_pairs_sql(src: str, cols: list[str]) -> str:
    """(a, b, pos_a, pos_b, r) for all pairs, as a UNION ALL of one-row
    aggregates; a constant column gives NULL."""
    parts = []
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            b = cols[j]
            parts.append(
                f"SELECT '{a}' AS a, '{b}' AS b, {i} AS pos_a, {j} AS pos_b, "
                f"abs(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)) AS r "
                f"FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return "\nUNION ALL\n".join(parts)


def selected_ctes() -> list[str]:
    """Correlation drop then variance filter, expressed on the long form so
    the kept set is data-driven in SQL too."""
    pos = ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATURES))
    return logged_ctes() + [
        f"corr AS ({corr_pairs_sql('logged', FEATURES)})",
        "corr_dropped AS (SELECT DISTINCT b AS feature FROM corr WHERE r > 0.8 AND NOT isnan(r))",
        "long AS (UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
        + " FROM logged) ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE v)",
        "variances AS (SELECT feature, var_pop(v) AS variance FROM long GROUP BY feature)",
        f"positions AS (SELECT * FROM (VALUES {pos}) t(feature, position))",
        "kept AS (SELECT p.feature, p.position FROM positions p JOIN variances v USING (feature) "
        "WHERE v.variance > 0.01 AND p.feature NOT IN (SELECT feature FROM corr_dropped))",
    ]


# ---- tasks, rule scorers, results ----------------------------------------

def hash_u(id_expr: str, seed: int = 42, salt: str = "") -> str:
    key = f"CAST({id_expr} AS VARCHAR) || ':{seed}'" + (f" || ':{salt}'" if salt else "")
    return (f"(CAST(CAST(('0x' || substr(md5({key}), 1, 15)) AS BIGINT) AS DOUBLE) "
            f"/ CAST(1152921504606846976 AS DOUBLE))")


def task_ctes(task, i: int, src: str = "logged") -> list[str]:
    """CTEs t{i}_base ... t{i} (id, y, split, rule features) and p{i}
    (rule predictions) for one task."""
    from tabmill.plans.tasks import CLF_RULES, REG_RULES, RULE_FEATURES
    feats = ", ".join(c for c in RULE_FEATURES if c != task.target)
    if task.kind == "regression":
        y = f"CAST({task.target} AS DOUBLE)"
    elif task.rule == "median_ge":
        y = f"CAST({task.target} >= (SELECT median({task.target}) FROM {src}) AS INTEGER)"
    elif task.rule == "median_gt":
        y = f"CAST({task.target} > (SELECT median({task.target}) FROM {src}) AS INTEGER)"
    else:
        cut = {"raw": f"{task.threshold}", "log10": f"log10({task.threshold})",
               "log1p": f"ln(1 + {task.threshold})"}[task.scale]
        y = f"CAST({task.target} >= {cut} AS INTEGER)"
    out = [f"t{i}_base AS (SELECT id, {y} AS y, {hash_u('id')} AS u, {task.target}, {feats} FROM {src})"]
    if task.stratify:
        out += [
            f"t{i}_cnt AS (SELECT y, round(0.2 * count(*)) AS t FROM t{i}_base GROUP BY y)",
            f"t{i}_rank AS (SELECT y, u, row_number() OVER (PARTITION BY y ORDER BY u) AS rn FROM t{i}_base)",
            f"t{i}_tau AS (SELECT r.y, max(r.u) AS tau FROM t{i}_rank r JOIN t{i}_cnt c USING (y) "
            f"WHERE r.rn <= c.t GROUP BY r.y)",
            f"t{i} AS (SELECT b.*, CASE WHEN b.u <= tau.tau THEN 'test' ELSE 'train' END AS split "
            f"FROM t{i}_base b LEFT JOIN t{i}_tau tau USING (y))",
        ]
    else:
        out.append(f"t{i} AS (SELECT *, CASE WHEN u < 0.2 THEN 'test' ELSE 'train' END AS split "
                   f"FROM t{i}_base)")
    head = f"SELECT '{task.name}' AS task, '{{m}}' AS model, {{o}} AS model_order, split, id, "
    if task.kind == "regression":
        preds = {
            "rule_price": "ln(1.0 + sum_price * (1.0 - avg_disc))",
            "train_median": f"(SELECT median(y) FROM t{i} WHERE split = 'train')",
            "train_mean": f"(SELECT avg(y) FROM t{i} WHERE split = 'train')",
        }
        parts = [head.format(m=m, o=o) + f"CAST(y AS DOUBLE) AS y, CAST({preds[m]} AS DOUBLE) AS p, "
                 f"CAST(NULL AS INTEGER) AS yhat FROM t{i}" for o, m in enumerate(REG_RULES)]
    else:
        qs = ", ".join(f"quantile_cont({f}, 0.5) AS {f}_m, "
                       f"quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) AS {f}_r"
                       for _, f in CLF_RULES)
        out.append(f"t{i}_q AS (SELECT {qs} FROM t{i} WHERE split = 'train')")
        parts = []
        for o, (m, f) in enumerate(CLF_RULES):
            z = (f"((CAST({f} AS DOUBLE) - q.{f}_m) / CASE WHEN q.{f}_r = 0 THEN 1.0 "
                 f"ELSE q.{f}_r END)")
            p = f"(0.5 + 0.5 * {z} / (1.0 + abs({z})))"
            parts.append(head.format(m=m, o=o) + f"CAST(y AS DOUBLE) AS y, {p} AS p, "
                         f"CAST({p} >= 0.5 AS INTEGER) AS yhat FROM t{i}, t{i}_q q")
    out.append(f"p{i} AS (" + " UNION ALL ".join(parts) + ")")
    return out


def preds_ctes(tasks) -> list[str]:
    out = []
    for i, t in enumerate(tasks):
        out += task_ctes(t, i)
    out.append("preds AS (" + " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(len(tasks))) + ")")
    return out


def results_ctes(tasks) -> list[str]:
    """Metrics per (task, model) on the test split, rounded to 3."""
    from tabmill.plans.tasks import TASKS
    reg = ", ".join(f"'{t.name}'" for t in tasks if t.kind == "regression") or "''"
    clf = ", ".join(f"'{t.name}'" for t in tasks if t.kind == "classification") or "''"
    cur = ", ".join(f"'{t.name}'" for t in tasks if t.kind == "classification" and t.curves) or "''"
    order = " ".join(f"WHEN '{t.name}' THEN {TASKS.index(t)}" for t in tasks)
    return logged_ctes() + preds_ctes(tasks) + [
        f"reg AS (SELECT task, model, model_order, count(*) AS n, avg((y - p) * (y - p)) AS mse, "
        f"1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0) AS r2, avg(abs(y - p)) AS mae "
        f"FROM preds WHERE split = 'test' AND task IN ({reg}) GROUP BY task, model, model_order)",
        f"cc AS (SELECT task, model, model_order, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, "
        f"count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, "
        f"count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn FROM preds WHERE split = 'test' "
        f"AND task IN ({clf}) GROUP BY task, model, model_order)",
        "clf AS (SELECT task, model, model_order, tp + fp + fn + tn AS n, "
        "CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS accuracy, "
        "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, "
        "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall, "
        "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM cc)",
        f"sc AS (SELECT task, model, model_order, p AS score, "
        f"CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos, "
        f"CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE) AS neg FROM preds WHERE split = 'test' "
        f"AND task IN ({cur}) GROUP BY task, model, model_order, p)",
        "cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM sc WINDOW w AS "
        "(PARTITION BY task, model, model_order ORDER BY score DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
        "curves AS (SELECT task, model, model_order, "
        "sum(neg * (tp - pos + pos / 2.0)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc, "
        "sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0) AS pr_auc FROM cum GROUP BY task, model, model_order)",
        "results AS ("
        "SELECT task, 'regression' AS kind, model, model_order, n, round(mse, 3) + 0.0 AS mse, "
        "round(r2, 3) + 0.0 AS r2, round(mae, 3) + 0.0 AS mae, CAST(NULL AS DOUBLE) AS accuracy, CAST(NULL AS DOUBLE) AS precision, "
        "CAST(NULL AS DOUBLE) AS recall, CAST(NULL AS DOUBLE) AS f1, CAST(NULL AS DOUBLE) AS roc_auc, "
        f"CAST(NULL AS DOUBLE) AS pr_auc, CASE task {order} END AS task_order FROM reg "
        "UNION ALL SELECT c.task, 'classification', c.model, c.model_order, c.n, NULL, NULL, NULL, "
        "round(c.accuracy, 3) + 0.0, round(c.precision, 3) + 0.0, round(c.recall, 3) + 0.0, "
        "round(c.f1, 3) + 0.0, "
        f"round(k.roc_auc, 3) + 0.0, round(k.pr_auc, 3) + 0.0, CASE c.task {order} END "
        "FROM clf c LEFT JOIN curves k USING (task, model, model_order))",
    ]
