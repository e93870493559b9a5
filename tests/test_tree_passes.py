"""Passes of the tree learners: small nodes of a round are finished together, histograms of a forest's pass are bounded."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from tabmill.trees import blocks as BL
from tabmill.trees import boosting as B
from tabmill.trees import forest as FO


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 3))
    y = np.sin(2 * x[:, 0]) + x[:, 1] ** 2 + 0.1 * rng.normal(size=3000)
    return spark.createDataFrame([(i, float(t), Vectors.dense(r)) for i, (r, t) in enumerate(zip(x.tolist(), y, strict=True))], ["id", "y", "features"]).repartition(3).cache()


def _same(a, b):
    assert all(np.array_equal(s[k], t[k]) for s, t in zip(a.trees, b.trees, strict=True) for k in ("feature", "bin", "left"))
    assert all(np.allclose(s["value"], t["value"]) for s, t in zip(a.trees, b.trees, strict=True))


@pytest.mark.parametrize("params", [B.BoostParams(rounds=2, depth=5), B.BoostParams(rounds=2, depth=0, leaves=9, min_rows=20)])
def test_one_finish_a_round(train, monkeypatch, params):
    whole = B.fit_boosting([(train, None)], [(0, params)], "regression")[0][0]
    calls, finish = [], B._finish
    monkeypatch.setattr(B, "_finish", lambda *a: calls.append(1) or finish(*a))
    monkeypatch.setattr(B, "LOCAL_ROWS", 700)
    _same(B.fit_boosting([(train, None)], [(0, params)], "regression")[0][0], whole)
    assert len(calls) == params.rounds


def test_forest_histograms_are_counted_in_bounded_passes(train, monkeypatch):
    params = FO.ForestParams(trees=4)
    whole = FO.fit_forest(train, params, local_rows=400)
    held, histograms = [], FO._histograms
    monkeypatch.setattr(FO, "_histograms", lambda p, d, large: held.append(sum(map(len, large.values()))) or histograms(p, d, large))
    monkeypatch.setattr(FO, "TASK_BYTES", 3 * 3 * 3 * FO.BINS * 8)
    parted = FO.fit_forest(train, params, local_rows=400)
    assert max(held) <= 3
    assert parted.top == whole.top and np.allclose(parted.importances, whole.importances)


def test_only_large_nodes_are_counted_in_passes(spark, train, monkeypatch):
    """A small node beside a large one goes to its own task at once, not through another pass over the table."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2000, 2))
    y = np.where(x[:, 0] > 1.3, 9.0, 0.0) + x[:, 1] + 0.1 * rng.normal(size=2000)  # the first split leaves some 200 rows on one side
    table = spark.createDataFrame([(i, float(t), Vectors.dense(r)) for i, (r, t) in enumerate(zip(x.tolist(), y, strict=True))], ["id", "y", "features"]).repartition(3)
    for kind, params in (("regression", B.BoostParams(rounds=2, depth=5)), ("classification", B.BoostParams(rounds=2, depth=0, leaves=9, min_rows=5, min_hessian=1e-3))):
        frame = table if kind == "regression" else table.withColumn("y", (table.y > 0).cast("double"))
        whole = B.fit_boosting([(frame, None)], [(0, params)], kind)[0][0]
        with monkeypatch.context() as patch:
            counted, ended, grow, count, rows = [], [], {}, B._count_pass, B._rows
            patch.setattr(B, "_count_pass", lambda state, late, growing, targets, *a: grow.update(growing) or counted.extend(
                growing[m].nodes[i].sums[2] for m, nodes in targets.items() for i in nodes) or count(state, late, growing, targets, *a))
            patch.setattr(B, "_rows", lambda k, d, places, late, routes, targets: ended.extend(
                grow[m].nodes[i].sums[2] for m, nodes in targets.items() for i in nodes) or rows(k, d, places, late, routes, targets))
            patch.setattr(B, "LOCAL_ROWS", 600)
            _same(B.fit_boosting([(frame, None)], [(0, params)], kind)[0][0], whole)
        assert len(counted) > 2 and min(counted) > 600 and ended and max(ended) <= 600


def test_scores_are_written_every_few_rounds(train, monkeypatch):
    """Rounds past a write go on from the written scores, with the trees since added by the passes."""
    params = B.BoostParams(rounds=5, depth=3)
    whole = B.fit_boosting([(train, train)], [(0, params)], "regression", with_errors=True)
    monkeypatch.setattr(B, "KEEP_EVERY", 2)
    monkeypatch.setattr(B, "LOCAL_ROWS", 700)
    parted = B.fit_boosting([(train, train)], [(0, params)], "regression", with_errors=True)
    _same(parted[0][0], whole[0][0])
    assert parted[1][0]["n"] == 3000 and np.isclose(parted[1][0]["sq"], whole[1][0]["sq"])


def test_passes_read_parts_of_many_blocks(spark, monkeypatch):
    """A task counts its rows as one part, not block by block, and never joins the rows of two pairs or of both sides."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(5000, 2))
    y = x[:, 0] + 0.1 * rng.normal(size=5000)
    rows = spark.createDataFrame([(i, float(t), Vectors.dense(r)) for i, (r, t) in enumerate(zip(x.tolist(), y, strict=True))], ["id", "y", "features"]).repartition(10).cache()
    kept, held = B.kept, []
    monkeypatch.setattr(B, "kept", lambda parts: held.append(sorted((p["pair"], p["fit"], len(p["y"])) for p in parts.collect())) or kept(parts))
    pairs = [(rows.where("id % 2 = 0"), rows.where("id % 2 = 1")), (rows, None)]
    params = B.BoostParams(rounds=1, depth=2)
    B.fit_boosting(pairs, [(0, params), (1, params)], "regression", with_errors=True)
    found, tasks = held[0], spark.sparkContext.defaultParallelism
    assert len(found) <= 3 * tasks and sum(n for *_, n in found) == 10000
    assert {key: sum(n for *k, n in found if tuple(k) == key) for key in ((0, True), (0, False), (1, True))} == {(0, True): 2500, (0, False): 2500, (1, True): 5000}
    monkeypatch.setattr(BL, "PART_ROWS", B.BLOCK_ROWS)
    held.clear()
    B.fit_boosting(pairs, [(0, params), (1, params)], "regression", with_errors=True)
    assert sum(n for *_, n in held[0]) == 10000 and len(held[0]) == 30  # a block each


def test_trees_of_many_rows_are_added_once(train, monkeypatch):
    """With many rows no pass adds earlier trees to the scores: each round does it once."""
    params = [B.BoostParams(rounds=4, depth=3), B.BoostParams(rounds=2, depth=0, leaves=6, min_rows=20)]
    frame = train.withColumn("y", (train.y > 1).cast("double"))
    few = B.fit_boosting([(frame, frame)], [(0, p) for p in params], "classification", with_errors=True)
    late, grow = [], B._grow
    monkeypatch.setattr(B, "_grow", lambda state, trees, *a: late.append(len(trees)) or grow(state, trees, *a))
    monkeypatch.setattr(B, "FEW_SCORES", 1000)
    many = B.fit_boosting([(frame, frame)], [(0, p) for p in params], "classification", with_errors=True)
    assert late == [0, 0, 0, 0]
    for a, b, e, f in zip(few[0], many[0], few[1], many[1], strict=True):
        _same(a, b)
        assert e == f and e["n"] == 3000


def test_a_forest_writes_no_nodes_of_its_rows(train, monkeypatch):
    """No table of a row's nodes in all trees, which grew with rows times trees in every task; large nodes and subtrees as before."""
    written, materialize = [], FO.materialize
    monkeypatch.setattr(FO, "materialize", lambda df, name: written.append((name, df.columns)) or materialize(df, name))
    fit = FO.fit_forest(train, FO.ForestParams(trees=3), local_rows=300)
    assert [name for name, _ in written] == ["forest-blocks", "forest-subtrees"] and not any("nodes" in columns for _, columns in written)
    ends = {(r["tree"], r["node"]) for r in fit.subtrees.select("tree", "node").collect()}
    for t, (splits, leaves) in enumerate(fit.top):
        assert len(splits) > 3 and all(node == 1 or node >> 1 in splits for node in splits)
        assert {c for node in splits for c in (2 * node, 2 * node + 1)} - set(splits) - set(leaves) == {node for tree, node in ends if tree == t}


def test_a_subtree_is_read_once_for_all_chunks():
    """A subtree comes once, before the chunks of rows that fall into it."""
    blank = {"batch": None, "tree": 0, "node": 5, "known": None, "rows": None, "x": None, "feature": None, "threshold": None, "left": None, "value": None}
    tree = {**blank, "feature": np.array([0, -1, -1], np.int16).tobytes(), "threshold": np.array([1.5, 0, 0]).tobytes(),
            "left": np.array([1, -1, -1], np.int32).tobytes(), "value": np.array([0, 10.0, 20.0]).tobytes()}
    chunk = lambda batch, x, **more: {**blank, "batch": batch, "rows": np.arange(len(x)).tobytes(), "x": np.array(x, float).tobytes(), **more}
    schema = pa.schema([("batch", pa.int64()), ("tree", pa.int32()), ("node", pa.int64()), ("known", pa.float64()), *[(c, pa.binary()) for c in ("rows", "x", "feature", "threshold", "left", "value")]])
    rows = [tree, chunk(0, [1, 2]), chunk(7, [3]), chunk(9, [1], node=6, known=4.0)]
    batches = [pa.RecordBatch.from_pylist(part, schema) for part in (rows[:2], rows[2:])]  # a subtree's chunks may go on in the next batch
    found = {r["batch"]: np.frombuffer(r["value"]).tolist() for batch in FO._evaluate(1)(iter(batches)) for r in batch.to_pylist()}
    assert found == {0: [10.0, 20.0], 7: [20.0], 9: [4.0]}
    with pytest.raises(ValueError):
        list(FO._evaluate(1)(iter([pa.RecordBatch.from_pylist([tree, chunk(0, [1], node=6)], schema)])))
