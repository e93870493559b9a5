"""Chart tables of several columns at once, against direct computation."""

import math

import numpy as np
import pytest

from tabmill.operators import chartdata


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(0, 1, 400), rng.normal(9, 0.2, 100), [60.0]])
    rows = [(float(x), None if i % 3 else float(i), 2.5, None) for i, x in enumerate(a)]
    return spark.createDataFrame(rows, "a double, b double, same double, none double").repartition(5)


def test_densities_are_within_the_stated_bound_of_the_exact_sum(frame):
    cols = ["a", "b", "same", "none"]
    got = {}
    for r in chartdata.densities(frame, cols, grid=40).collect():
        got.setdefault(r["feature"], []).append((r["x"], r["density"]))
    assert sorted(got) == ["a", "b"]  # no spread, no values: no curve
    pdf = frame.toPandas()
    for c, points in got.items():
        v = pdf[c].dropna().to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 40)
        points.sort()
        assert np.allclose([x for x, _ in points], grid, rtol=0, atol=1e-9)
        height = 1 / (h * math.sqrt(2 * math.pi))
        exact = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).mean(axis=1) * height
        assert np.abs(np.array([d for _, d in points]) - exact).max() <= 6e-10 * height
    one = chartdata.kde(frame, "a", grid=40).collect()
    assert np.allclose(sorted((r["x"], r["density"]) for r in one), got["a"], rtol=1e-9, atol=0)


def test_histograms_count_every_column(frame):
    rows = chartdata.histograms(frame, ["a", "b", "same", "none"], bins=4).collect()
    pdf = frame.toPandas()
    for c in ("a", "b"):
        v = pdf[c].dropna().to_numpy()
        mine = sorted((r["bin"], r["n"], r["lo"], r["hi"]) for r in rows if r["feature"] == c)
        want, edges = np.histogram(v, bins=4)
        assert [n for _, n, _, _ in mine] == want.tolist()
        assert np.allclose([lo for *_, lo, _ in mine] + [mine[-1][3]], edges)
    assert [r["n"] for r in sorted((r for r in rows if r["feature"] == "same"), key=lambda r: r["bin"])] == [len(pdf), 0, 0, 0]
    assert not [r for r in rows if r["feature"] == "none"]


def test_empty_tables_have_no_charts(frame):
    empty = frame.limit(0)
    assert chartdata.histograms(empty, ["a", "b"]).count() == 0 and chartdata.densities(empty, ["a", "b"]).count() == 0
