"""Rounds of the exact quantiles: targets of one bracket share its sketch and its counts."""

import numpy as np
import pytest

from tabmill.functions import quantiles as Q


@pytest.mark.parametrize("spread", [50, 10**6])
def test_a_row_meets_a_bracket_once(spark, monkeypatch, spread):
    rng = np.random.default_rng(5)
    rows = [(float(a), None if b % 7 == 0 else float(b)) for a, b in rng.integers(0, spread, (4000, 2))]
    df = spark.createDataFrame(rows, "a double, b double")
    sizes, frame = [], Q._targets_frame

    def noted(data, keys, targets, extra):
        sizes.append(len(targets))
        return frame(data, keys, targets, extra)
    monkeypatch.setattr(Q, "_targets_frame", noted)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = Q.column_quantiles(df, ["a", "b"], probs, max_bracket=20)
    assert sizes[0] == 2  # one bracket a column, however many ranks are wanted
    assert sizes[1] <= 2 * -(-2 * len(probs) // Q.PAIRS)
    for i, c in enumerate("ab"):
        values = [r[i] for r in rows if r[i] is not None]
        assert [got[c][p] for p in probs] == pytest.approx([float(np.quantile(values, p)) for p in probs])


def test_one_round_leaves_a_small_bracket(spark, monkeypatch):
    """A bracket ends within a few 2,048ths of its rows: at 60,000 rows and 200 values one round of sketch and counts is enough."""
    values = np.random.default_rng(6).normal(size=(60_000, 2))
    df = spark.createDataFrame(values.tolist(), "a double, b double")
    rounds, narrow = [], Q._narrow
    monkeypatch.setattr(Q, "_narrow", lambda *args: rounds.append(narrow(*args)))
    got = Q.column_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], max_bracket=200)
    assert len(rounds) == 1
    for i, c in enumerate("ab"):
        assert [got[c][p] for p in (0.25, 0.5, 0.75)] == pytest.approx(np.quantile(values[:, i], [0.25, 0.5, 0.75]).tolist())


def test_rounds_after_the_first_read_only_what_is_left(spark, monkeypatch):
    """The count of the first round hands on the values between its cuts; summaries of chunks, nulls and ties included."""
    rng = np.random.default_rng(8)
    rows = [(float(a), None if i % 5 == 0 else float(b)) for i, (a, b) in enumerate(zip(rng.normal(size=30_000), rng.integers(0, 40, 30_000), strict=True))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    read, finish = [], Q._finish
    monkeypatch.setattr(Q, "_finish", lambda data, keys, small: (read.append(data.count()) if small else None, finish(data, keys, small)))
    monkeypatch.setattr(Q, "POINTS_LOG2", 12)
    monkeypatch.setattr(Q, "CHUNK", 4000)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = Q.column_quantiles(df, ["a", "b"], probs, max_bracket=600)
    assert sum(read) < 6_000  # of 54,000 values
    for i, c in enumerate("ab"):
        values = [r[i] for r in rows if r[i] is not None]
        assert [got[c][p] for p in probs] == pytest.approx([float(np.quantile(values, p)) for p in probs])
    long = df.unpivot([], ["a", "b"], "k", "v")
    assert Q.exact_quantiles(long, ["k"], "v", probs, max_bracket=600) == {(c,): got[c] for c in "ab"}
