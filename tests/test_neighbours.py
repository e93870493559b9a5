"""Exact neighbours against all pairs, and how many rows visit another chunk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.operators import balance


def _points(spark, xs, as_text=False):
    rows = [(f"p{i:06d}" if as_text else i, *map(float, x)) for i, x in enumerate(xs)]
    cols = [f"f{j}" for j in range(xs.shape[1])]
    return spark.createDataFrame(rows, f"id {'string' if as_text else 'bigint'}, " + ", ".join(f"{c} double" for c in cols)).repartition(5), cols


def _plain(xs, k):
    out = {}
    for i, x in enumerate(xs):
        d = np.zeros(len(xs))
        for j in range(xs.shape[1]):
            d += (x[j] - xs[:, j]) ** 2
        order = [n for n in np.lexsort((np.arange(len(xs)), d)) if n != i][:k]
        out[i] = [(n, d[n]) for n in order]
    return out


@pytest.mark.parametrize("kind", ["clustered", "copies", "spread", "offset"])
def test_neighbours_equal_all_pairs(spark, kind, monkeypatch):
    monkeypatch.setattr(balance, "LEAF_ROWS", 32)
    monkeypatch.setattr(balance, "CELL_ROWS", 100)
    rng = np.random.default_rng(5)
    if kind == "clustered":
        xs = rng.normal(size=(12, 6))[rng.integers(0, 12, 350)] * 20 + rng.normal(size=(350, 6))
    elif kind == "copies":                     # a third of the rows are one point, others tie on a grid
        xs = np.r_[np.ones((110, 4)), rng.integers(0, 3, (230, 4))]
    elif kind == "spread":
        xs = rng.normal(size=(300, 9))
    else:                                      # far from the origin, near to each other
        xs = 1e7 + rng.integers(0, 50, (250, 5)) / 16
    points, cols = _points(spark, xs, as_text=kind == "spread")
    got = {}
    for r in balance.knn_self(points, "id", cols, 4, chunk_rows=90).orderBy("id", "nb_rank").collect():
        number = lambda v: int(v[1:]) if isinstance(v, str) else v
        got.setdefault(number(r["id"]), []).append((number(r["nb_id"]), r["dist"]))
        assert list(xs[number(r["nb_id"])]) == r["nb_vec"]
    assert got == _plain(xs, 4)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_points(spark, n):
    xs = np.arange(n * 2, dtype=float).reshape(n, 2)
    points, cols = _points(spark, xs)
    got = [(r["id"], r["nb_rank"]) for r in balance.knn_self(points, "id", cols, 3).collect()]
    assert sorted(got) == [(i, rank) for i in range(n) for rank in range(1, min(3, n - 1) + 1)]


def test_clusters_visit_few_chunks(spark, monkeypatch):
    """Rows times chunks visited, besides the own one, of all."""
    monkeypatch.setattr(balance, "CELL_ROWS", 100)
    seen = {}
    real = balance.visits

    def counted(own, pivots, cells, chunks, d):
        blocks = real(own, pivots, cells, chunks, d)
        seen["visits"] = blocks.select(F.sum(F.size("ids"))).first()[0] or 0
        seen["all"] = sum(n for n, _ in cells.values()) * (own.count() - 1)
        return blocks

    monkeypatch.setattr(balance, "visits", counted)
    rng = np.random.default_rng(6)
    xs = rng.normal(size=(20, 8))[np.arange(2000) % 20] * 50 + rng.normal(size=(2000, 8))
    points, cols = _points(spark, xs)
    balance.knn_self(points, "id", cols, 5).count()
    assert seen["visits"] < 0.2 * seen["all"]


def test_chunks_go_to_a_group_once(spark, monkeypatch):
    """Points spread over nine features, of which each reaches most chunks: what is sent is a chunk for a group, not for a row."""
    monkeypatch.setattr(balance, "LEAF_ROWS", 32)
    monkeypatch.setattr(balance, "CELL_ROWS", 60)
    monkeypatch.setattr(balance, "GROUP_ROWS", 200, raising=False)
    kept = {}
    real = balance.materialize
    monkeypatch.setattr(balance, "materialize", lambda df, name="stage": kept.setdefault(name, real(df, name)))
    xs = np.random.default_rng(7).uniform(size=(900, 9))
    points, cols = _points(spark, xs)
    got = {}
    for r in balance.knn_self(points, "id", cols, 4, chunk_rows=60).orderBy("id", "nb_rank").collect():
        got.setdefault(r["id"], []).append((r["nb_id"], r["dist"]))
    assert got == _plain(xs, 4)
    sent = kept["needs"].join(kept["chunks"].drop("grp"), ["cell", "sub"])
    groups = kept["chunks"].agg(F.countDistinct("grp")).first()[0]
    assert 4 <= groups < 9
    assert kept["needs"].groupBy("grp", "cell", "sub").count().where("count > 1").isEmpty()
    assert sent.select(F.sum(F.size("ids"))).first()[0] <= groups * len(xs)
    assert kept["chunks"].columns == ["cell", "sub", "grp", "ids", "vecs", "bounds", "low", "high"]


def test_rows_of_one_id_share_its_ranks(spark):
    """As one ranking by id: of a repeated id all rows ask, none is a neighbour of the others."""
    xs = np.random.default_rng(8).integers(0, 6, (60, 3)).astype(float)
    ids = [i % 45 for i in range(60)]
    points = spark.createDataFrame([(i, *map(float, x)) for i, x in zip(ids, xs, strict=True)], "id bigint, a double, b double, c double")
    got = {}
    for r in balance.knn_self(points, "id", ["a", "b", "c"], 3).orderBy("id", "nb_rank").collect():
        got.setdefault(r["id"], []).append((r["dist"], r["nb_id"]))
    want = {i: sorted((((xs[n] - xs[m]) ** 2).sum(), ids[m]) for n in range(60) if ids[n] == i for m in range(60) if ids[m] != i)[:3] for i in ids}
    assert got == want


def test_only_neighbours_taken_are_joined(spark):
    """Each copy takes one neighbour: no more rows than copies meet the sources."""
    xs = np.random.default_rng(9).normal(size=(40, 2))
    points, cols = _points(spark, xs)
    nbrs = balance.knn_self(points, "id", cols, 4)
    syn = balance.synthesize(points, nbrs, "id", cols, 50, 40, 4, 42)
    rows = syn.collect()
    assert len(rows) == 50
    rank = {(r["id"], r["nb_id"]): r["nb_rank"] for r in nbrs.collect()}
    for r in rows:
        assert (r["source_id"], r["neighbor_id"]) in rank
        a, b = xs[r["source_id"]], xs[r["neighbor_id"]]
        assert np.allclose([r["f0"], r["f1"]], a + r["gap"] * (b - a))
    assert "collect_list" not in syn._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
