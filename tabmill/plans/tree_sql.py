"""SQL for the first tree of a boosting model, level-wise to depth two or leaf-wise to four leaves, on quantile bins."""

from __future__ import annotations

from tabmill.trees.blocks import BINS
from tabmill.trees.boosting import BoostParams

FEATURES = ["n_lines", "nation", "max_price", "acctbal", "avg_size", "yr"]


def _soft(x: str, p: BoostParams) -> str:
    return f"(sign({x}) * greatest(abs({x}) - {p.l1}, 0))"


def _level(k: int, p: BoostParams) -> list[str]:
    """The best split of every node of level k, and the rows of the next."""
    gain = " ".join(f"{sign} {_soft(g, p)} * {_soft(g, p)} / ({h} + {p.l2})" for sign, g, h in
                    (("", "gl", "hl"), ("+", "(gt - gl)", "(ht - hl)"), ("-", "gt", "ht")))
    over, to = "OVER (PARTITION BY node, fi)", "OVER (PARTITION BY node, fi ORDER BY e NULLS LAST)"
    return [
        f"h{k} AS (SELECT node, fi, e, sum(g) AS g, sum(h) AS h, count(*) AS c FROM b JOIN n{k} USING (rid) GROUP BY ALL)",
        f"c{k} AS (SELECT node, fi, e, sum(g) {to} AS gl, sum(h) {to} AS hl, sum(c) {to} AS cl, sum(g) {over} AS gt, sum(h) {over} AS ht, sum(c) {over} AS ct FROM h{k})",
        f"g{k} AS (SELECT node, fi, e, {gain} AS gain FROM c{k} WHERE e IS NOT NULL AND cl >= {p.min_rows} AND ct - cl >= {p.min_rows} "
        f"AND hl >= {p.min_hessian} AND ht - hl >= {p.min_hessian} AND ct >= {p.min_split})",
        f"s{k} AS (SELECT * FROM g{k} WHERE gain > 1e-10 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 7) DESC, fi, e) = 1)",
        f"n{k + 1} AS (SELECT rid, 2 * node + CASE WHEN v > s{k}.e THEN 1 ELSE 0 END AS node FROM n{k} JOIN s{k} USING (node) JOIN b USING (rid, fi))",
        f"w{k} AS (SELECT node, sum(g) AS g, sum(h) AS h FROM n{k} JOIN d USING (rid) GROUP BY node)"]


def first_tree_ctes(kind: str, p: BoostParams) -> list[str]:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    h = "1.0::double" if kind == "regression" else "m * (1 - m)"
    order = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(FEATURES)) + " END"
    probs = ", ".join(str(i / BINS) for i in range(1, BINS))
    ctes = [
        f"tr AS (SELECT row_number() OVER () AS rid, CAST(y AS DOUBLE) AS y, {cols} FROM (SELECT id, y FROM t0 WHERE split = 'train') JOIN logged USING (id))",
        f"d AS (SELECT rid, m - y AS g, {h} AS h FROM tr, (SELECT avg(y) AS m FROM tr))",
        f"lg AS (SELECT rid, {order} AS fi, v FROM (UNPIVOT (SELECT rid, {', '.join(FEATURES)} FROM tr) ON {', '.join(FEATURES)} INTO NAME feature VALUE v))",
        f"q AS (SELECT fi, unnest(list_distinct(quantile_disc(v, [{probs}]))) AS e, max(v) AS top FROM lg GROUP BY fi)",
        "ed AS (SELECT fi, e FROM q WHERE e < top)",
        "b AS (SELECT rid, lg.fi, v, ed.e AS e, g, h FROM lg ASOF LEFT JOIN ed ON lg.fi = ed.fi AND lg.v <= ed.e JOIN d USING (rid))",
        "n0 AS (SELECT rid, 1 AS node FROM tr)", *_level(0, p), *_level(1, p)]
    if p.leaves == 4:
        ctes += [*_level(2, p), "p1 AS (SELECT * FROM s0)", "p2 AS (SELECT * FROM s1 ORDER BY gain DESC, node LIMIT 1)",
                 "p3 AS (SELECT * FROM (SELECT * FROM s1 WHERE node NOT IN (SELECT node FROM p2) UNION ALL SELECT * FROM s2 WHERE node // 2 IN (SELECT node FROM p2)) "
                 "ORDER BY gain DESC, node LIMIT 1)",
                 "sp AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)",
                 "w3 AS (SELECT node, sum(g) AS g, sum(h) AS h FROM n3 JOIN d USING (rid) GROUP BY node)", "w AS (SELECT * FROM w0 UNION ALL SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)"]
    elif p.depth == 2 and not p.leaves:
        ctes += ["sp AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1)", "w2 AS (SELECT node, sum(g) AS g, sum(h) AS h FROM n2 JOIN d USING (rid) GROUP BY node)",
                 "w AS (SELECT * FROM w0 UNION ALL SELECT * FROM w1 UNION ALL SELECT * FROM w2)"]
    else:
        raise ValueError("the SQL is for depth two or four leaves")
    return ctes


def first_tree_sql(p: BoostParams) -> str:
    names = "[" + ", ".join(f"'{c}'" for c in FEATURES) + "]"
    leaf = f"-{p.rate} * {_soft('g', p)} / (h + {p.l2})"
    return (f"SELECT CAST(node AS BIGINT) AS node, {names}[fi + 1] AS feature, e AS threshold, round(gain, 4) + 0.0 AS gain, CAST(NULL AS DOUBLE) AS value FROM sp "
            f"UNION ALL SELECT CAST(node AS BIGINT), NULL, NULL, NULL, round({leaf}, 8) + 0.0 FROM w "
            "WHERE node NOT IN (SELECT node FROM sp) AND (node = 1 OR node // 2 IN (SELECT node FROM sp))")
