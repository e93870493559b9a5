"""Exact order statistics without holding a whole group in one task.

Spark's exact ``percentile`` and ``mode`` aggregates keep every distinct
value of a group in one buffer, so a global median over a large table ends
in a single task holding the column. Here the k-th smallest value is found
by narrowing:

1. count the non-null values of each group (one aggregate);
2. while a target's bracket holds more than ``max_bracket`` values, a
   ``percentile_approx`` grid (a bounded sketch, merged map-side) over the
   bracket gives two values that straddle rank k; exact counts below and at
   them give the new, much smaller bracket (the open interval between them),
   or the answer itself when rank k falls on one of the two values. For few
   brackets both steps run on sorted Arrow chunks: the sketch is fed every
   s-th value of a chunk, and the count also hands on the values between the
   cuts, so that what follows reads those alone;
3. once a bracket holds at most ``max_bracket`` values, those values (and
   only those) are sorted in one task per bracket and rank k is read off.

Every job is one aggregate with map-side combine over a broadcast join with
a target table built on the driver from already collected group counts, so
its size is known (groups x ranks). Ties are resolved by the at-value
counts, so a value that holds a third of all rows ends the search at once.
Only scalars reach the driver.

Quantiles interpolate linearly between ranks floor((n-1)q) and the next one,
as pandas, NumPy and DuckDB's ``quantile_cont`` do: ``lo + (hi - lo) * frac``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.session import materialize

DEFAULT_MAX_BRACKET = 200_000
DEFAULT_ACCURACY = 10_000
GRID = 256
FINE_GRID = 2048     # leaves a bracket an eighth as large; for few brackets, as the sketches' values reach the driver
FINE_BRACKETS = 256
PAIRS = 4  # pairs of cuts that one pass over a row counts
CHUNK = 1 << 20      # values that a task sorts at a time
POINTS_LOG2 = 19     # a bracket's sketch is fed at least 2^19 values, or all
MAX_BROADCAST_TARGETS = 100_000  # beyond so many (group, rank) rows the join is left to Spark


@dataclass
class _Target:
    group: tuple
    k: int                     # 0-based rank wanted
    lo: float | None = None    # bracket is lo < v < hi (None = unbounded)
    hi: float | None = None
    below: int = 0             # values of the group <= lo (0 when lo is None)
    size: int = 0              # values inside the bracket
    value: float | None = None


def _key_fields(data: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [T.StructField(k, data.schema[k].dataType, True) for k in keys]


def _targets_frame(data: DataFrame, keys: list[str], rows: list[tuple],
                   extra: list[T.StructField]) -> DataFrame:
    schema = T.StructType([T.StructField("__t", T.LongType(), False)]
                          + _key_fields(data, keys) + extra)
    frame = data.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= MAX_BROADCAST_TARGETS else frame


def _join_targets(data: DataFrame, keys: list[str], targets: DataFrame) -> DataFrame:
    # null-safe equality on the typed keys: any key type, NULL groups included
    targets = targets.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    cond = [data[k].eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return data.join(targets, cond, "inner").drop(*[f"__k_{k}" for k in keys])


def _in_bracket():
    v = F.col("__v")
    return ((F.col("__lo").isNull() | (v > F.col("__lo")))
            & (F.col("__hi").isNull() | (v < F.col("__hi"))))


def _prepare(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, list[str]]:
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    if not keys:
        data = data.withColumn("__g", F.lit(0))
        keys = ["__g"]
    return data, keys


def group_sizes(df: DataFrame, keys: list[str], value: str) -> dict[tuple, int]:
    """Non-null, non-NaN count of ``value`` per group (``()`` for no keys)."""
    data = df.select(*keys, F.col(value).cast("double").alias("__v"))
    rows = data.groupBy(*keys).agg(
        F.count_if(F.col("__v").isNotNull() & ~F.isnan("__v")).alias("__n")).collect()
    return {tuple(r[k] for k in keys): int(r["__n"]) for r in rows}


def kth_smallest(df: DataFrame, keys: list[str], value: str,
                 ranks: dict[tuple, list[int]],
                 max_bracket: int = DEFAULT_MAX_BRACKET,
                 accuracy: int = DEFAULT_ACCURACY,
                 sizes: dict[tuple, int] | None = None,
                 wide: DataFrame | None = None) -> dict[tuple, dict[int, float]]:
    """Exact k-th smallest non-null value per group. ``wide``: the same values with
    a column of doubles per group, named as its key; the first round reads those.

    ``ranks`` maps a group tuple (values of ``keys``; ``()`` when ``keys`` is
    empty) to the 0-based ranks wanted. Returns {group: {k: value}}."""
    if sizes is None:
        sizes = group_sizes(df, keys, value)
    data, jkeys = _prepare(df, keys, value)
    targets: list[_Target] = []
    seen = set()
    for g, ks in ranks.items():
        for k in ks:
            if (g, k) in seen or not (0 <= k < sizes.get(g, 0)):
                continue
            seen.add((g, k))
            targets.append(_Target(group=g, k=int(k), size=int(sizes[g])))

    # The first round re-reads the (column-pruned) input rather than caching
    # it, and writes the values that are left in its brackets; the others read
    # those. Brackets that were small from the start need the input.
    big = [t for t in targets if t.size > max_bracket]
    small = [t for t in targets if t.size <= max_bracket]
    while big:
        left = _narrow(data, jkeys, big, accuracy, wide)
        if left is None:
            small += [t for t in big if t.value is None and t.size <= max_bracket]
            big = [t for t in big if t.value is None and t.size > max_bracket]
            continue
        while rest := [t for t in big if t.value is None and t.size > max_bracket]:
            _narrow(left, jkeys, rest, accuracy)
        _finish(left, jkeys, [t for t in big if t.value is None])
        big = []
    _finish(data, jkeys, small)

    out: dict[tuple, dict[int, float]] = {}
    for t in targets:
        out.setdefault(t.group, {})[t.k] = t.value
    return out


def _gkey(keys: list[str], g: tuple) -> tuple:
    return (0,) if keys == ["__g"] else g


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(bracket, its values, rising) of every ``CHUNK`` rows of (bracket, value)."""
    def parts(held):
        t = np.concatenate([b.column(0).to_numpy() for b in held])
        v = np.concatenate([b.column(1).to_numpy() for b in held])
        order = np.argsort(t.astype(np.int16), kind="stable")  # at most FINE_BRACKETS of them
        ids, begin = np.unique(t[order], return_index=True)
        for i, values in zip(ids.tolist(), np.split(v[order], begin[1:])):
            yield i, np.sort(values)
    return _held(batches, parts, CHUNK)


def _column_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The same of rows with a column for each bracket."""
    def parts(held):
        for i in range(held[0].num_columns):
            v = np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held])
            v = np.sort(v)
            v = v[:len(v) - int(np.isnan(v).sum())]  # absent values are last
            if len(v):
                yield i, v
    return _held(batches, parts, CHUNK // 4)


def _held(batches: Iterator[pa.RecordBatch], parts, cells: int) -> Iterator[tuple[int, np.ndarray]]:
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= cells // max(1, batch.num_columns // 4):
            yield from parts(held)
            held, n = [], 0
    if n:
        yield from parts(held)


def _every(steps: list[int], chunks):
    """Of every chunk the ends and each ``steps[bracket]``-th value: a summary whose ranks are off by half a step a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, values in chunks(batches):
            v = values if steps[t] == 1 else np.concatenate([values[:1], values[steps[t] // 2::steps[t]], values[-1:]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int64)), pa.array(v)], ["__t", "__v"])
    return run


def _between(cuts: list[list[tuple[float, float]]], chunks):
    """Of every chunk: per pair of cuts the values below and up to each, and those strictly between the cuts of any pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, values in chunks(batches):
            a, b = np.array(cuts[t]).T
            ends = [np.searchsorted(values, c, side) for c in (a, b) for side in ("left", "right")]
            inside = np.zeros(len(values) + 1, np.int64)
            np.add.at(inside, ends[1], 1)
            np.add.at(inside, np.maximum(ends[1], ends[2]), -1)
            yield pa.RecordBatch.from_pydict({"__t": pa.array([t], pa.int64()), "__c": pa.array([np.stack(ends, 1).ravel().tolist()], pa.list_(pa.int64())),
                                              "__vs": pa.array([values[np.cumsum(inside[:-1]) > 0]], pa.list_(pa.float64()))})
    return run


def _narrow(data: DataFrame, keys: list[str], big: list[_Target], accuracy: int, wide: DataFrame | None = None) -> DataFrame | None:
    """One refinement round for every oversized bracket. Targets of one bracket share its sketch, and targets between the
    same two cuts their counts; a row meets a bracket once, or with many brackets once for every ``PAIRS`` pairs of cuts.
    Returns the values inside the new brackets, written, if the round has them: brackets were few, one a group, and all
    cuts straddled their ranks."""
    brackets: dict[tuple, int] = {}
    for t in big:
        brackets.setdefault((t.group, t.lo, t.hi), len(brackets))
    bounds = [T.StructField("__lo", T.DoubleType()), T.StructField("__hi", T.DoubleType())]
    rows = [(bid, *_gkey(keys, g), lo, hi) for (g, lo, hi), bid in brackets.items()]
    tdf = _targets_frame(data, keys, rows, bounds)
    cells = FINE_GRID if len(brackets) <= FINE_BRACKETS else GRID
    grid = [i / cells for i in range(cells + 1)]
    points, chunks = _join_targets(data, keys, tdf).where(_in_bracket()).select("__t", "__v"), _chunks
    fine = len(brackets) <= FINE_BRACKETS
    if fine:
        if wide is not None and all(lo is None and hi is None for _, lo, hi in brackets):
            points, chunks = wide.select(*[g[0] for g, _, _ in brackets]), _column_chunks
        sizes = {(t.group, t.lo, t.hi): t.size for t in big}
        summary = points.mapInArrow(_every([max(1, sizes[b] >> POINTS_LOG2) for b in brackets], chunks), "__t long, __v double")
    sketch = ((summary if fine else points).groupBy("__t").agg(F.percentile_approx("__v", grid, accuracy).alias("__q"))
              .collect())
    qs = {r["__t"]: r["__q"] for r in sketch}

    cuts: list[tuple] = []                     # of every target: its bracket and cuts
    pairs: dict[tuple, list[tuple]] = {}       # of every bracket: the different cuts
    for t in big:
        bracket = (t.group, t.lo, t.hi)
        q = qs[brackets[bracket]]
        rel = (t.k - t.below) / max(t.size - 1, 1)
        # A sketch value's rank is off by at most size/accuracy; step one grid
        # cell plus that error outward on both sides.
        pad = 1 + math.ceil(cells / accuracy)
        j = int(rel * cells)
        pair = (float(q[max(j - pad, 0)]), float(q[min(j + 1 + pad, cells)]))
        cuts.append((bracket, pair))
        if pair not in pairs.setdefault(bracket, []):
            pairs[bracket].append(pair)

    if fine:
        tdf = _targets_frame(data, keys, rows, bounds)
        if chunks is _chunks:
            points = _join_targets(data, keys, tdf).where(_in_bracket()).select("__t", "__v")
        return _narrow_fine(points, chunks, keys, big, cuts, pairs, tdf)
    rows, place = [], {}
    for bracket, found in pairs.items():
        g, lo, hi = bracket
        for s in range(0, len(found), PAIRS):
            part = found[s:s + PAIRS]
            place.update({(bracket, pair): (len(rows), i) for i, pair in enumerate(part)})
            flat = [x for pair in part for x in pair]
            rows.append((len(rows), *_gkey(keys, g), lo, hi, *flat, *[None] * (2 * PAIRS - len(flat))))
    cut_fields = [T.StructField(f"__{c}{i}", T.DoubleType()) for i in range(PAIRS) for c in "ab"]
    cdf = _targets_frame(data, keys, rows, bounds + cut_fields)
    v = F.col("__v")
    tests = []
    for i in range(PAIRS):
        a, b = F.col(f"__a{i}"), F.col(f"__b{i}")
        tests += [F.count_if(v < a).alias(f"lta{i}"), F.count_if(v <= a).alias(f"lea{i}"),
                  F.count_if(v < b).alias(f"ltb{i}"), F.count_if(v <= b).alias(f"leb{i}")]
    counts = _join_targets(data, keys, cdf).where(_in_bracket()).groupBy("__t").agg(*tests).collect()
    got = {r["__t"]: r for r in counts}
    for t, (bracket, pair) in zip(big, cuts, strict=True):
        row, i = place[bracket, pair]
        _settle(t, pair, [int(got[row][f"{c}{i}"]) for c in ("lta", "lea", "ltb", "leb")])
    return None


def _narrow_fine(points: DataFrame, chunks, keys: list[str], big: list[_Target], cuts: list[tuple], pairs: dict[tuple, list[tuple]], tdf: DataFrame) -> DataFrame | None:
    """The counts of a round with few brackets, and the values that are left, from one pass over sorted chunks."""
    out = materialize(points.mapInArrow(_between(list(pairs.values()), chunks), "__t long, __c array<bigint>, __vs array<double>"), "bracket")
    counts = out.select("__t", F.posexplode("__c").alias("i", "c")).groupBy("__t", "i").agg(F.sum("c").alias("c")).collect()
    got = {(r["__t"], r["i"]): int(r["c"]) for r in counts}
    ids, straddled = {bracket: i for i, bracket in enumerate(pairs)}, True
    for t, (bracket, pair) in zip(big, cuts, strict=True):
        at = pairs[bracket].index(pair)
        straddled &= _settle(t, pair, [got[ids[bracket], 4 * at + i] for i in range(4)])
    if not straddled or len({g for g, _, _ in pairs}) < len(pairs):
        return None
    values = out.select("__t", F.explode("__vs").alias("__v"))
    return values.join(F.broadcast(tdf.select("__t", *keys)), "__t").select(*keys, "__v")


def _settle(t: _Target, pair: tuple[float, float], counts: list[int]) -> bool:
    """Notes a target's value or new bracket, from the counts of its old bracket below and up to each cut. False: the cuts
    did not straddle its rank."""
    ca, cb = pair
    # the cuts are values of the bracket: what lies below it adds to every count
    lta, lea, ltb, leb = (t.below + c for c in counts)
    if lta <= t.k < lea:
        t.value = ca
    elif ltb <= t.k < leb:
        t.value = cb
    elif lea <= t.k < ltb:
        t.lo, t.hi, t.below, t.size = ca, cb, lea, ltb - lea
    else:
        # fall back to one side, which still shrinks the bracket since ranks are exact
        if t.k < lta:
            t.hi, t.size = ca, lta - t.below
        else:
            t.lo, t.size, t.below = cb, t.size - (leb - t.below), leb
        return False
    return True


def _finish(data: DataFrame, keys: list[str], small: list[_Target]) -> None:
    """Sort each remaining bracket (at most max_bracket values) in one task
    and read off the ranks. Targets sharing a bracket share the sort."""
    if not small:
        return
    brackets: dict[tuple, int] = {}
    for t in small:
        brackets.setdefault((t.group, t.lo, t.hi), len(brackets))
    wanted: dict[int, set[int]] = {}
    for t in small:
        wanted.setdefault(brackets[(t.group, t.lo, t.hi)], set()).add(t.k - t.below)
    rows = [(bid, *_gkey(keys, g), lo, hi, sorted(wanted[bid]))
            for (g, lo, hi), bid in brackets.items()]
    fields = [T.StructField("__lo", T.DoubleType()), T.StructField("__hi", T.DoubleType()),
              T.StructField("__pos", T.ArrayType(T.IntegerType()))]
    bdf = _targets_frame(data, keys, rows, fields)
    picked = (_join_targets(data, keys, bdf).where(_in_bracket())
              .groupBy("__t", "__pos")
              .agg(F.array_sort(F.collect_list("__v")).alias("__a"))
              .select("__t", "__pos",
                      F.transform("__pos", lambda p: F.element_at("__a", p + 1)).alias("__vals"))
              .collect())
    got = {}
    for r in picked:
        for p, val in zip(r["__pos"], r["__vals"]):
            got[(r["__t"], p)] = val
    for t in small:
        t.value = got.get((brackets[(t.group, t.lo, t.hi)], t.k - t.below))


def interpolate(lo: float, hi: float, frac: float) -> float:
    return lo if frac == 0 else lo + (hi - lo) * frac


def quantile_ranks(n: int, q: float) -> tuple[int, int, float]:
    h = (n - 1) * q
    k0 = int(math.floor(h))
    k1 = min(k0 + 1, n - 1)
    return k0, k1, h - k0


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    max_bracket: int = DEFAULT_MAX_BRACKET,
                    accuracy: int = DEFAULT_ACCURACY) -> dict[tuple, dict[float, float | None]]:
    """Exact linear-interpolated quantiles of ``value`` per group of ``keys``.

    Returns {group: {q: value, or None when the group has no values}}."""
    sizes = group_sizes(df, keys, value)
    ranks: dict[tuple, list[int]] = {}
    for g, n in sizes.items():
        if n:
            for q in probs:
                k0, k1, _ = quantile_ranks(n, q)
                ranks.setdefault(g, []).extend([k0, k1])
    kth = kth_smallest(df, keys, value, ranks, max_bracket, accuracy, sizes=sizes)
    out: dict[tuple, dict[float, float | None]] = {}
    for g, n in sizes.items():
        for q in probs:
            if n == 0:
                out.setdefault(g, {})[q] = None
                continue
            k0, k1, frac = quantile_ranks(n, q)
            out.setdefault(g, {})[q] = interpolate(kth[g][k0], kth[g][k1], frac)
    return out


def column_kth(df: DataFrame, cols: list[str], ranks: Callable[[int], list[int]],
               max_bracket: int = DEFAULT_MAX_BRACKET,
               accuracy: int = DEFAULT_ACCURACY) -> tuple[dict[tuple, dict[int, float]], dict[tuple, int]]:
    """Exact k-th smallest values of several columns, for the ranks that ``ranks`` gives for
    a column's count of values; and the counts. Both by (column,)."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    present = wide.agg(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(c)).alias(c) for c in cols]).first()
    sizes = {(c,): int(present[c]) for c in cols}
    wanted = {g: ranks(n) for g, n in sizes.items() if n}
    long = wide.unpivot([], cols, "__feature", "__val")
    return kth_smallest(long, ["__feature"], "__val", wanted, max_bracket, accuracy, sizes=sizes, wide=wide), sizes


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     max_bracket: int = DEFAULT_MAX_BRACKET,
                     accuracy: int = DEFAULT_ACCURACY, with_sizes: bool = False):
    """Exact quantiles of several columns at once, through one long
    (feature, v) frame so each job is one aggregate whatever the width.
    With ``with_sizes`` also returns the non-null count per column."""
    if not cols:
        return ({}, {}) if with_sizes else {}
    def ranks(n: int) -> list[int]:
        return [k for q in probs for k in quantile_ranks(n, q)[:2]] if n else []
    kth, sizes = column_kth(df, cols, ranks, max_bracket, accuracy)
    out = {c: {q: None for q in probs} for c in cols}
    for (feat,), n in sizes.items():
        if n:
            for q in probs:
                k0, k1, frac = quantile_ranks(n, q)
                out[feat][q] = interpolate(kth[(feat,)][k0], kth[(feat,)][k1], frac)
    if with_sizes:
        return out, {c: sizes.get((c,), 0) for c in cols}
    return out


def column_medians(df: DataFrame, cols: list[str], **kw) -> dict[str, float | None]:
    return {c: qs[0.5] for c, qs in column_quantiles(df, cols, [0.5], **kw).items()}
