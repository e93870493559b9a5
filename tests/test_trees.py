"""Forests and boosting against plain versions of the same rules."""

import heapq

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabmill.trees import blocks, boosting, forest
from tabmill.trees.boosting import BoostParams
from tabmill.trees.forest import ForestParams


def table(spark, x, y, extra="id"):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, f"{extra} long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def scored(fit, df):
    return np.array([r["p"] for r in fit.score(df, "p").orderBy("id").collect()])


# ---- forests ----

def plain_tree(x, y, w, depth, min_split, min_leaf):
    """One tree by recursion and trial of every cut: a function from row to value."""
    total, sums = w.sum(), (w * y).sum()
    best = None
    if depth != 0 and len(y) >= min_split and y.min() < y.max():
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                left = x[:, f] <= a
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                lw, ls = w[left].sum(), (w * (y - sums / total))[left].sum()
                score = ls ** 2 / lw + ls ** 2 / (total - lw)
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, a + (b - a) / 2)
    if best is None:
        return lambda row: sums / total
    _, f, cut = best
    left = x[:, f] <= cut
    a, b = (plain_tree(x[s], y[s], w[s], depth - 1, min_split, min_leaf) for s in (left, ~left))
    return lambda row: a(row) if row[f] <= cut else b(row)


@pytest.mark.parametrize("depth,min_split,min_leaf", [(-1, 2, 1), (3, 2, 1), (-1, 12, 1), (-1, 2, 5), (0, 2, 1)])
def test_subtree_equals_plain_tree(depth, min_split, min_leaf):
    rng = np.random.default_rng(depth + min_split + min_leaf)
    x, y, w = rng.normal(size=(150, 4)), rng.normal(size=150), rng.integers(1, 4, 150).astype(float)
    x[:, 3] = np.round(x[:, 3])
    found = forest.grow(x, y, w, depth, min_split, min_leaf, 4)
    ours = found["value"][forest._descend(x, found["feature"], found["threshold"], found["left"])]
    plain = plain_tree(x, y, w, depth, min_split, min_leaf)
    assert np.allclose(ours, [plain(r) for r in x])
    if (depth, min_split, min_leaf) == (-1, 2, 1):
        assert np.allclose(ours, y)  # pure leaves


def test_whole_forest_equals_plain_trees(spark):
    """Unlimited trees on drawn rows: every tree of the table equals a plain one, whole or grown through large nodes."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(260, 3)).round(6), rng.normal(size=260)
    df = table(spark, x, y)
    keys = np.array([r[0] for r in df.select(blocks._row_hash(df)).collect()], np.int64).view(np.uint64)
    params = ForestParams(trees=3)
    want = np.zeros(len(y))
    for t in range(3):
        w = forest.draw_weights(keys, t, params.seed)
        assert 0.5 < (w > 0).mean() < 0.75 and 0.8 < w.mean() < 1.2
        plain = plain_tree(x[w > 0], y[w > 0], w[w > 0], -1, 2, 1)
        want += np.array([plain(r) for r in x]) / 3
    fit = forest.fit_forest(df, params)
    assert np.allclose(scored(fit, df), want)
    assert np.allclose(scored(forest.fit_forest(df.repartition(5), params), df.repartition(3)), want)  # however rows are dealt
    by_level = forest.fit_forest(df, ForestParams(trees=1), local_rows=60)
    assert len(by_level.top[0][0]) >= 3 and by_level.subtrees.count() > 3
    drawn = forest.draw_weights(keys, 0, 42) > 0
    assert np.allclose(scored(by_level, df)[drawn], y[drawn])  # pure leaves below large nodes too
    assert abs(fit.importances.sum() - 1) < 1e-9 and len(fit.importances) == 3


def test_forest_limits_and_odd_tables(spark):
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 3, (300, 2)).astype(float), rng.integers(0, 2, 300).astype(float)
    df = table(spark, x, y, "id")
    stump = forest.fit_forest(df, ForestParams(trees=2, depth=1), local_rows=20)
    assert all(len(s) == 1 for s, _ in stump.top) and len(set(scored(stump, df).round(12))) <= 4
    same = table(spark, np.ones((50, 2)), rng.normal(size=50))
    assert len(set(scored(forest.fit_forest(same, ForestParams(trees=3), local_rows=10), same))) == 1
    proba = scored(forest.fit_forest(df, ForestParams(trees=5, features="sqrt")), df)
    assert ((proba >= 0) & (proba <= 1)).all()
    for bad in (dict(trees=0), dict(depth=31), dict(min_split=1), dict(min_leaf=0), dict(features="third")):
        with pytest.raises(ValueError):
            ForestParams(**bad)


def test_split_features_are_drawn_by_node():
    usable = np.ones((200, 9), bool)
    usable[:, 4] = False
    tried = forest._tried_features(np.arange(200, dtype=np.uint64), 0, 42, usable, 3)
    assert (tried.sum(1) == 3).all() and not tried[:, 4].any() and len({tuple(t) for t in tried}) > 30
    assert 40 < tried[:, 0].sum() < 115
    assert (forest._tried_features(np.arange(5, dtype=np.uint64), 0, 42, np.zeros((5, 9), bool), 3)).sum() == 0


# ---- boosting ----

def plain_boosting(x, y, p, kind):
    """Rounds of best-first growth, one split at a time."""
    base = y.mean() if kind == "regression" else np.log(y.mean() / (1 - y.mean()))
    score = np.full(len(y), base)
    soft = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    for _ in range(p.rounds):
        g, h = boosting.gradients(kind, y, score)
        h = np.ones(len(y)) if h is None else h

        def best(rows):
            found = None
            q = lambda r: soft(g[r].sum()) ** 2 / ((h[r].sum() if p.newton else len(r)) + p.l2)
            for f in range(x.shape[1]) if len(rows) >= p.min_split else ():
                for v in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                    if min(len(a), len(b)) >= p.min_rows and min(h[a].sum(), h[b].sum()) >= p.min_hessian:
                        gain = q(a) + q(b) - q(rows)
                        if gain > 1e-10 and (found is None or gain > found[0] + 1e-9):
                            found = (gain, a, b)
            return found
        queue, leaves, n = [(0.0, 0, np.arange(len(y)), 0, best(np.arange(len(y))))], [], 1
        done = []
        while queue:
            _, _, rows, depth, found = heapq.heappop(queue)
            if found is None or (p.depth and depth >= p.depth) or (p.leaves and n >= p.leaves):
                done.append(rows)
                continue
            n += 1
            for part in found[1:]:
                b = best(part)
                queue.append((-(b[0] if b else 0.0), len(leaves) + len(queue) + n * 1000, part, depth + 1, b))
            heapq.heapify(queue)
        for rows in done:
            score[rows] -= p.rate * soft(g[rows].sum()) / (h[rows].sum() + p.l2)
    return score if kind == "regression" else 1 / (1 + np.exp(-score))


PARAMS = [BoostParams(rounds=2, depth=3, rate=0.3, l2=1.0, l1=0.7, min_hessian=1.0), BoostParams(rounds=2, depth=0, leaves=6, rate=0.1, min_rows=8),
          BoostParams(rounds=1, depth=2, rate=0.1, newton=False, min_split=20), BoostParams(rounds=2, depth=4, leaves=5, rate=0.2, l1=2.0), BoostParams(rounds=1, depth=0, leaves=2)]


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_boosting_equals_plain_rounds(spark, kind, monkeypatch):
    """All models in shared passes equal plain ones; so they do if every node is counted in passes over the table."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.permutation(200), rng.integers(0, 9, 200), rng.normal(size=200).round(3)], 1).astype(float)
    y = (x[:, 0] / 50 + x[:, 1] * rng.normal(1, .2, 200)).round(4)
    y = y if kind == "regression" else (y > np.median(y)).astype(float)
    df = table(spark, x, y)
    want = [plain_boosting(x, y, p, kind) for p in PARAMS]
    local, _ = boosting.fit_boosting([(df, None)], [(0, p) for p in PARAMS], kind)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 4)
    monkeypatch.setattr(boosting, "TASK_BYTES", 40000)
    passes, _ = boosting.fit_boosting([(df.repartition(3), None)], [(0, p) for p in PARAMS], kind)
    for p, w, a, b in zip(PARAMS, want, local, passes):
        assert len(a.trees) == len(b.trees) == p.rounds
        assert np.allclose(scored(a, df), w, atol=1e-9), p
        assert np.allclose(scored(b, df), w, atol=1e-9), p
        assert abs(a.importances.sum() - 1) < 1e-9


def test_search_in_shared_passes_equals_single_fits(spark):
    from tabmill.operators import split
    from tabmill.plans import models as M
    from tabmill.plans import tune as TU
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(240, 3)), rng.normal(size=240)
    y += x[:, 0] * 2
    df = split.kfold_assign(table(spark, x, y), "id", 3)
    folds = [(df.where(F.col("fold") != f), df.where(F.col("fold") == f)) for f in range(3)]
    draws = [{"maxIter": 2, "maxDepth": 3, "stepSize": 0.3, "regLambda": 5.0}, {"maxIter": 1, "maxDepth": 2, "stepSize": 0.1}, {"maxIter": 0, "maxDepth": 2}]
    _, best, trials = TU.tune(df, "XGB", "regression", draws, folds, "mse", 240)
    for draw, trial in list(zip(draws, trials))[:2]:
        parts = []
        for a, b in folds:
            out = M.build("XGB", "regression", draw).fit(a).transform(b)
            parts.append(out.select(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0])
        assert abs(sum(parts) / 3 - trial[2]) < 1e-9
    assert best in draws[:2] and trials[2][2] == float("inf") and "error" in trials[2][1]
    label = df.withColumn("y", (F.col("y") > 0).cast("double"))
    pairs = [(label.where(F.col("fold") != f), label.where(F.col("fold") == f)) for f in range(3)]
    for objective in ("f1", "accuracy"):
        _, _, trials = TU.tune(label, "LGB", "classification", [{"maxIter": 2, "maxDepth": 0, "numLeaves": 4, "minInstancesPerNode": 5, "stepSize": 0.3}], pairs, objective, 240)
        parts = []
        for a, b in pairs:
            rows = M.build("LGB", "classification", {"maxIter": 2, "maxDepth": 0, "numLeaves": 4, "minInstancesPerNode": 5, "stepSize": 0.3}).fit(a).transform(b).select("y", "prediction").collect()
            tp, fp, fn = (sum((r["prediction"] == p) & (r["y"] == t) for r in rows) for p, t in ((1, 1), (1, 0), (0, 1)))
            parts.append(2 * tp / (2 * tp + fp + fn) if objective == "f1" else 1 - (fp + fn) / len(rows))
        assert abs(sum(parts) / 3 - trials[0][2]) < 1e-9


def test_boosting_parameters_out_of_range():
    for bad in (dict(rounds=0), dict(rate=0.0), dict(depth=0), dict(leaves=1), dict(l2=-1.0), dict(min_rows=0)):
        with pytest.raises(ValueError):
            BoostParams(**bad)


def test_bins_hold_all_values_of_a_short_feature(spark):
    df = table(spark, np.array([[i % 7, i] for i in range(1000)], float), np.zeros(1000))
    edges = blocks.bin_edges(df)
    assert edges[0].tolist() == [0, 1, 2, 3, 4, 5] and len(edges[1]) == 255
    assert blocks.to_bins(np.array([[3.0, 0.0], [6.0, 999.0], [99.0, -5.0]]), edges)[:, 0].tolist() == [3, 6, 6]
