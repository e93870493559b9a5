"""Random forests without a depth limit, grown level by level on Spark.

No row keeps its nodes: bins, targets and row hashes are kept by the executors as parts, and a pass sends a part's rows down the
splits of large nodes, one tree after another, so what a task holds does not grow with the trees. While a node has more than
``LOCAL_ROWS`` different rows, its histograms (one per task and node) are added up in Spark and its split is chosen there; they
say how many rows its children have. As soon as a node has fewer, its rows meet in one
task, which grows the rest of that subtree on the exact values; a task's memory is bound by ``LOCAL_ROWS``, and there are as
many such tasks as (tree, node) pairs. The driver sees the splits of large nodes only: at most rows / LOCAL_ROWS a tree.

The model is a table, one row per subtree, as a forest of pure leaves is as large as its training data times its trees.
Scoring sends rows to subtrees: chunks of rows come to the subtree they fall into, sorted behind it, so that each subtree is read once.

Rows are drawn with a Poisson(1) weight from a hash of (row, tree), the form of the bootstrap that needs no pass over the
rows; so a forest does not depend on how rows are dealt. Splits lower the weighted variance the most (for 0/1 targets the same as
Gini). Leaves are pure, or constant in all features, unless a limit says otherwise. Row limits count different rows."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.session import materialize
from tabmill.trees.blocks import BINS, Block, arrays, bin_edges, blocks, dealt, histogram, kept, mix, part_rows, sides

LOCAL_ROWS = 8192
MAX_DEPTH = 30
#: Bytes of histograms that one task may hold: nodes beyond it are counted in further passes.
TASK_BYTES = 96 << 20
#: Rows that are sent to the subtrees together, and whose trees are averaged in one task.
CHUNK_ROWS = 1 << 15
#: Gains this near to the best are equal to it: the first feature and cut wins, whatever the rounding.
SAME = 1 - 1e-9
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class ForestParams:
    """``depth`` 0: no limit. ``features``: how many a split looks at ("all", "sqrt")."""
    trees: int = 100
    depth: int = 0
    min_split: int = 2
    min_leaf: int = 1
    features: str = "all"
    seed: int = 42

    def __post_init__(self):
        if self.trees < 1 or not 0 <= self.depth <= MAX_DEPTH or self.min_split < 2 or self.min_leaf < 1 or self.features not in ("all", "sqrt"):
            raise ValueError(f"forest parameters out of range: {self}")

    def tried(self, d: int) -> int:
        return d if self.features == "all" else max(1, int(math.sqrt(d)))


def draw_weights(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    salt = mix(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    u = (mix(rows ^ salt) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return np.searchsorted(_POISSON, u, "right").astype(np.float64)


def _tried_features(nodes: np.ndarray, tree: int, seed: int, usable: np.ndarray, k: int) -> np.ndarray:
    """Per node, ``k`` features by a hash among the ``usable`` ones (a matrix of nodes by features)."""
    if k >= usable.shape[1]:
        return usable
    salt = mix(np.array([seed * 7_368_787 + tree + 1], np.uint64))
    keys = mix(mix(nodes.astype(np.uint64) ^ salt)[:, None] + np.arange(usable.shape[1], dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
    keys = np.where(usable, keys >> np.uint64(1), np.uint64(2 ** 64 - 1))
    limit = np.sort(keys, axis=1)[:, k - 1:k]
    return usable & (keys <= limit)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, min_split: int, min_leaf: int, k: int, tree: int = 0,
         root: int = 1, seed: int = 42) -> dict[str, np.ndarray]:
    """The whole subtree of some rows, all nodes of a level at a time: feature (-1: leaf), threshold (left: at most), left
    (right is the next), value, and gain, the weighted variance a split takes away. ``depth``: levels left, -1 for no limit."""
    n, d = x.shape
    columns, wy = np.ascontiguousarray(x.T), w * y
    mean = np.zeros(n)                    # of every row's node: sums of small numbers keep their digits
    order = np.argsort(columns, axis=1, kind="stable")
    slot = np.zeros(n, np.int64)          # of every row, its node among those open
    ids = np.zeros(1, np.int64)           # where the open nodes are in the result
    names = np.array([root], np.uint64)   # for the choice of features; they wrap around far down
    out = {"feature": [np.full(1, -1)], "threshold": [np.zeros(1)], "left": [np.full(1, -1)], "value": [np.zeros(1)], "gain": [np.zeros(1)]}
    size, level = 1, 0
    found = {key: np.concatenate(v) for key, v in out.items()}
    while len(ids):
        place = slot[order]
        by_node = np.argsort(place.astype(np.int16 if len(ids) < 2 ** 15 else np.int64), axis=1, kind="stable")
        order = np.take_along_axis(order, by_node, 1)
        node = np.take_along_axis(place[:1], by_node[:1], 1)[0]
        count = np.bincount(node, minlength=len(ids))
        start = np.cumsum(count) - count
        first = order[0]
        total_w, total = np.add.reduceat(w[first], start), np.add.reduceat(wy[first], start)
        found["value"][ids] = total / total_w
        mean[first] = (total / total_w)[node]
        low, high = np.minimum.reduceat(y[first], start), np.maximum.reduceat(y[first], start)
        may = (low < high) & (count >= max(min_split, 2 * min_leaf)) & (depth < 0 or level < depth)
        if not may.any():
            break
        values = np.take_along_axis(columns, order, 1)
        cw, cy = np.cumsum(w[order], 1), np.cumsum((wy - w * mean)[order], 1)
        before_w = np.where(start > 0, cw[:, start - 1], 0.0)
        before_y = np.where(start > 0, cy[:, start - 1], 0.0)
        lw, ly = cw - before_w[:, node], cy - before_y[:, node]
        rw = total_w[node] - lw
        pos = np.arange(len(node)) - start[node] + 1
        open_here = may[node] & (pos >= min_leaf) & (count[node] - pos >= min_leaf)
        ok = np.zeros(values.shape, bool)
        ok[:, :-1] = (values[:, :-1] < values[:, 1:]) & (node[:-1] == node[1:]) & open_here[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(ok, ly ** 2 / lw + ly ** 2 / rw, -np.inf)
        best = np.maximum.reduceat(score, start, axis=1)
        chosen = _tried_features(names, tree, seed, np.isfinite(best.T), k)
        per_node = np.where(chosen, best.T, -np.inf)
        f = np.argmax(per_node >= (per_node.max(1) * SAME)[:, None], axis=1)
        split = np.flatnonzero(np.isfinite(per_node[np.arange(len(ids)), f]))
        if not len(split):
            break
        at = np.full(len(ids), -1)
        for j in range(d):  # the first place of the best score, in the chosen feature
            mine = split[f[split] == j]
            if len(mine):
                hit = np.where(score[j] >= best[j][node] * SAME, np.arange(len(node)), len(node))
                at[mine] = np.minimum.reduceat(hit, start)[mine]
        a, b = values[f[split], at[split]], values[f[split], at[split] + 1]
        cut = a + (b - a) / 2
        cut = np.where((cut >= b) | (cut < a), a, cut)
        left = size + 2 * np.arange(len(split))
        found["feature"][ids[split]], found["threshold"][ids[split]], found["left"][ids[split]] = f[split], cut, left
        found["gain"][ids[split]] = per_node[split, f[split]]
        size += 2 * len(split)
        blank = {"feature": -1, "threshold": 0.0, "left": -1, "value": 0.0, "gain": 0.0}
        found = {key: np.concatenate([v, np.full(2 * len(split), blank[key])]) for key, v in found.items()}
        rank = np.full(len(ids), -1)
        rank[split] = np.arange(len(split))
        r = rank[slot]
        live = (r >= 0) & (slot >= 0)
        rows = np.flatnonzero(live)
        r = r[rows]
        right = columns[f[split][r], rows] > cut[r]
        slot = np.full(n, -1)
        slot[rows] = 2 * r + right
        order = order[slot[order] >= 0].reshape(d, -1)
        ids = np.stack([left, left + 1], 1).ravel()
        names = np.stack([names[split] * np.uint64(2), names[split] * np.uint64(2) + np.uint64(1)], 1).ravel()
        level += 1
    return found


def _descend(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    at = np.zeros(len(x), np.int64)
    while True:
        f = feature[at]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return at
        at[inner] = left[at[inner]] + (x[inner, f[inner]] > threshold[at[inner]])


# ---- large nodes, level by level ----

def _joined(d: int):
    """The blocks as parts: bins by feature, targets, row hashes."""
    most = part_rows(9 * d + 16)

    def joined(some: list[Block]) -> dict:
        return {"columns": np.concatenate([b.bins.T for b in some], axis=1), "y": np.concatenate([b.y for b in some]), "rows": np.concatenate([b.rows for b in some]),
                "x": np.concatenate([b.x for b in some]) if some[0].x is not None else None}

    def run(records: Iterator[dict]) -> Iterator[dict]:
        some: list[Block] = []
        for record in records:
            block = Block(record, d)
            if some and sum(b.n for b in some) + block.n > most:
                yield joined(some)
                some = []
            some.append(block)
        if some:
            yield joined(some)
    return run


def _drawn(params: ForestParams):
    """(tree, different rows), from every task."""
    def run(parts: Iterator[dict]) -> Iterator[tuple]:
        counts = np.zeros(params.trees, np.int64)
        for part in parts:
            counts += [np.count_nonzero(draw_weights(part["rows"], t, params.seed)) for t in range(params.trees)]
        yield from enumerate(counts.tolist())
    return run


def _down(columns: np.ndarray, rows: np.ndarray, splits: dict[int, tuple[int, int]], wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its rows) below the splits (left: bins up to the split's); of the ``wanted`` nodes alone if given."""
    above = None if wanted is None else {node >> k for node in wanted for k in range(node.bit_length())}
    todo = [(1, rows)]
    while todo:
        node, rows = todo.pop()
        if not len(rows) or (above is not None and node not in above):
            continue
        if node in splits:
            f, b = splits[node]
            left, right = sides(columns[f], rows, b)
            todo += [(2 * node + 1, right), (2 * node, left)]
        else:
            yield node, rows


def _placed(params: ForestParams, splits: list[dict], large: dict[int, np.ndarray]):
    """(part, tree, weights, large nodes with their rows), tree after tree."""
    def run(parts: Iterator[dict]) -> Iterator[tuple]:
        for part in parts:
            for t, nodes in large.items():
                w = draw_weights(part["rows"], t, params.seed)
                yield part, t, w, _down(part["columns"], np.flatnonzero(w), splits[t], set(nodes.tolist()))
    return run


def _passes(large: dict[int, list], d: int) -> list[dict[int, np.ndarray]]:
    """The large nodes by tree, dealt to passes whose histograms fit a task."""
    most, out, held = max(1, TASK_BYTES // (3 * d * BINS * 8)), [], 0
    for t, nodes in sorted(large.items()):
        nodes = sorted(nodes)
        while nodes:
            if held % most == 0:
                out.append({})
            part, nodes = nodes[:most - held % most], nodes[most - held % most:]
            out[-1][t] = np.array(part)
            held += len(part)
    return out


def _histograms(params: ForestParams, d: int, large: dict[int, np.ndarray]):
    """Per task and large node: the range of the target, and weights, weighted targets and rows by (feature, bin)."""
    def run(placed: Iterator[tuple]) -> Iterator[tuple]:
        names = {(t, node): i for i, (t, node) in enumerate((t, int(node)) for t, nodes in large.items() for node in nodes)}
        sums, low, high = np.zeros((len(names), 3, d * BINS)), np.full(len(names), math.inf), np.full(len(names), -math.inf)
        for part, t, w, nodes in placed:
            wy = w * part["y"]
            for node, rows in nodes:
                i, y = names[t, node], part["y"][rows]
                sums[i] += histogram(part["columns"], rows, w, wy, BINS)
                low[i], high[i] = min(low[i], y.min()), max(high[i], y.max())
        for key, i in names.items():
            if low[i] <= high[i]:
                yield key, (low[i], high[i], sums[i])
    return run


def _best_split(params: ForestParams, d: int, last: bool):
    """(feature, -1 for a leaf, bin, value, gain, rows up to the bin and above it) of the nodes whose tasks' histograms are a partition."""
    def split(tree: int, node: int, low: float, high: float, hist: np.ndarray) -> tuple:
        w, s, c = hist.reshape(3, d, BINS)
        lw, ls, lc = (np.cumsum(v, 1)[:, :-1] for v in (w, s, c))
        tw, ts, tc = w[0].sum(), s[0].sum(), c[0].sum()
        ok = (lc >= params.min_leaf) & (tc - lc >= params.min_leaf)
        apart = ls - lw * (ts / tw)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(ok, apart ** 2 / lw + apart ** 2 / (tw - lw), -np.inf)
        usable = np.isfinite(score.max(1))[None, :]
        tried = _tried_features(np.array([node], np.uint64), tree, params.seed, usable, params.tried(d))[0]
        score[~tried] = -np.inf
        f, b = np.unravel_index(int(np.argmax(score >= score.max() * SAME)), score.shape)
        if last or low >= high or tc < params.min_split or not np.isfinite(score[f, b]):
            return -1, 0, float(ts / tw), 0.0, 0, 0
        return int(f), int(b), float(ts / tw), float(score[f, b]), int(lc[f, b]), int(tc - lc[f, b])

    def run(parts: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[tuple[int, int], tuple] = {}
        for key, (low, high, hist) in parts:
            if key in held:
                before = held[key]
                low, high, hist = min(low, before[0]), max(high, before[1]), before[2] + hist
            held[key] = low, high, hist
        for (tree, node), found in held.items():
            yield (tree, node), split(tree, node, *found)
    return run


# ---- small nodes: their subtrees, whole ----

def _parts(params: ForestParams, d: int, splits: list[dict], done: list[dict]):
    """The rows of every node that is not split, by (tree, node); nodes in ``done`` are leaves already."""
    join = _joined(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
        for part in join(records):
            for t in range(params.trees):
                w = draw_weights(part["rows"], t, params.seed)
                some = [(node, rows) for node, rows in _down(part["columns"], np.flatnonzero(w), splits[t]) if node not in done[t]]
                if some:
                    cuts = [rows for _, rows in some]
                    yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(some), t, np.int32)), "node": pa.array([node for node, _ in some], pa.int64()), **{
                        name: pa.array([values[c].tobytes() for c in cuts], pa.binary()) for name, values in (("rows", part["rows"]), ("x", part["x"]), ("y", part["y"]), ("w", w))}})
    return run


_SUBTREE = "tree int, node long, feature binary, threshold binary, left binary, value binary, gains array<double>"


def _subtree(params: ForestParams, d: int):
    def run(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        y, w = (np.concatenate([np.frombuffer(v, np.float64) for v in table.column(c).to_pylist()]) for c in ("y", "w"))
        rows = np.concatenate([np.frombuffer(v, np.int64) for v in table.column("rows").to_pylist()])
        x = np.concatenate([np.frombuffer(v, np.float64) for v in table.column("x").to_pylist()]).reshape(-1, d)
        order = np.argsort(rows, kind="stable")  # sums do not depend on which block came first
        above = node.bit_length() - 1
        found = grow(x[order], y[order], w[order], params.depth - above if params.depth else -1, params.min_split, params.min_leaf, params.tried(d), tree, node, params.seed)
        gains = np.bincount(found["feature"][found["feature"] >= 0], found["gain"][found["feature"] >= 0], d)
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), "feature": [found["feature"].astype(np.int16).tobytes()],
                         "threshold": [found["threshold"].tobytes()], "left": [found["left"].astype(np.int32).tobytes()],
                         "value": [found["value"].tobytes()], "gains": pa.array([gains.tolist()], pa.list_(pa.float64()))})
    return run


@dataclass
class RandomForestFit:
    """``top``: per tree the splits of large nodes {node: (feature, threshold)} and their leaves {node: value};
    ``subtrees``: a written table of the rest."""
    params: ForestParams
    d: int
    top: list[tuple[dict, dict]]
    top_gains: np.ndarray
    subtrees: DataFrame

    @functools.cached_property
    def importances(self) -> np.ndarray:
        """Per feature: its share of the variance taken away, a mean over the trees."""
        rows = self.subtrees.select("tree", F.posexplode("gains").alias("f", "g")).groupBy("tree", "f").agg(F.sum("g").alias("g")).collect()
        gains = self.top_gains.copy()
        for r in rows:
            gains[r["tree"], r["f"]] += r["g"]
        total = gains.sum(1, keepdims=True)
        shares = np.divide(gains, total, out=np.zeros_like(gains), where=total > 0).sum(0)
        return shares / shares.sum() if shares.sum() > 0 else shares

    def score(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the forest's mean in ``out``. Each row's chunk meets the subtrees it falls into."""
        key = "__forest_row"
        while key in df.columns:
            key += "_"
        base = materialize(df.withColumn(key, F.monotonically_increasing_id()), "forest-rows")
        chunks = base.select(F.col(key).alias("row"), vector_to_array("features").alias("x")).mapInArrow(
            _route(self.top), "batch long, tree int, node long, known double, rows binary, x binary")
        met = chunks.unionByName(self.subtrees.drop("gains"), allowMissingColumns=True).repartition("tree", "node")
        parts = met.sortWithinPartitions("tree", "node", F.col("batch").isNotNull()).mapInArrow(_evaluate(self.d), "batch long, rows binary, value binary")
        means = parts.groupBy("batch").applyInArrow(_mean(self.params.trees, key, out), f"`{key}` long, `{out}` double")
        return base.join(means, key).drop(key)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and features of up to ``CHUNK_ROWS`` rows."""
    some: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if some and sum(len(r) for r, _ in some) + batch.num_rows > CHUNK_ROWS:
            yield tuple(map(np.concatenate, zip(*some)))
            some = []
        some.append((batch.column("row").to_numpy(zero_copy_only=False), arrays(batch, "x")))
    if some:
        yield tuple(map(np.concatenate, zip(*some)))


def _route(top: list[tuple[dict, dict]]):
    """Chunks of rows by (tree, node), down the splits of large nodes; ``known``: the value of a large leaf."""
    types = {"batch": pa.int64(), "tree": pa.int32(), "node": pa.int64(), "known": pa.float64(), "rows": pa.binary(), "x": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _chunks(batches):
            columns = np.ascontiguousarray(x.T)
            for t, (splits, leaves) in enumerate(top):
                made, todo = [], [(1, np.arange(len(rows)))]
                while todo:
                    node, at = todo.pop()
                    if not len(at):
                        continue
                    if node in splits:
                        f, cut = splits[node]
                        right = columns[f][at] > cut
                        todo += [(2 * node, at[~right]), (2 * node + 1, at[right])]
                    else:
                        known = leaves.get(node)
                        made.append((int(rows[0]), t, node, known, rows[at].tobytes(), x[at].tobytes() if known is None else b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made), types.values())], list(types))
    return run


def _evaluate(d: int):
    """The values of rows in their leaves; each subtree comes before the chunks that fall into it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: tuple | None = None
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                name, number = (get("tree"), get("node")), get("batch")
                if number is None:
                    tree = name, [np.frombuffer(get(c), kind) for c, kind in (("feature", np.int16), ("threshold", np.float64), ("left", np.int32), ("value", np.float64))]
                    continue
                rows, known = get("rows"), get("known")
                if known is None:
                    if tree is None or tree[0] != name:
                        raise ValueError(f"no subtree at {name}")
                    feature, threshold, left, values = tree[1]
                    value = values[_descend(np.frombuffer(get("x"), np.float64).reshape(-1, d), feature, threshold, left)]
                else:
                    value = np.full(len(rows) // 8, known)
                made.append((number, rows, value.tobytes()))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made), (pa.int64(), pa.binary(), pa.binary()))], ["batch", "rows", "value"])
    return run


def _mean(trees: int, key: str, out: str):
    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(v, np.int64) for v in table.column("rows").to_pylist()])
        value = np.concatenate([np.frombuffer(v, np.float64) for v in table.column("value").to_pylist()])
        order = np.lexsort((value, rows))  # one order of adding, whichever tree came first
        ids, begin = np.unique(rows[order], return_index=True)
        return pa.table([pa.array(ids, pa.int64()), pa.array(np.add.reduceat(value[order], begin) / trees)], names=[key, out])
    return run


def fit_forest(train: DataFrame, params: ForestParams, local_rows: int = LOCAL_ROWS) -> RandomForestFit:
    """A forest on ``features`` and ``y`` of ``train``."""
    edges = bin_edges(train)
    d = len(edges)
    table = materialize(blocks(train, edges), "forest-blocks")
    trees = params.trees
    parallel = train.sparkSession.sparkContext.defaultParallelism
    spread = table.select("n", "bins", "y", "rows").repartition(parallel)
    parts = kept(spread.rdd.map(lambda r: r.asDict()).mapPartitions(_joined(d)))
    counts = parts.mapPartitions(_drawn(params)).reduceByKey(np.add).collect()
    large = {t: [1] for t, n in counts if n > local_rows}
    bins: list[dict] = [{} for _ in range(trees)]    # the splits by bin, as passes need them
    splits: list[dict] = [{} for _ in range(trees)]  # and by value
    leaves: list[dict] = [{} for _ in range(trees)]
    gains, level = np.zeros((trees, d)), 0
    while large:
        found = []
        for some in _passes(large, d):
            keys = [(t, int(node)) for t, nodes in some.items() for node in nodes]
            n = min(len(keys), parallel)
            above = [splits_of if t in some else {} for t, splits_of in enumerate(bins)]
            hists = parts.mapPartitions(_placed(params, above, some)).mapPartitions(_histograms(params, d, some))
            found += hists.partitionBy(n, dealt(keys, n)).mapPartitions(_best_split(params, d, 0 < params.depth <= level)).collect()
        large, level = {}, level + 1
        for (t, node), (f, b, value, gain, *rows) in found:
            if f < 0:
                leaves[t][node] = value
                continue
            bins[t][node], splits[t][node] = (f, b), (f, float(edges[f][b]))
            gains[t, f] += gain
            more = [2 * node + i for i, n in enumerate(rows) if n > local_rows]
            if more:
                large.setdefault(t, []).extend(more)
    parts.unpersist()
    rows = table.mapInArrow(_parts(params, d, bins, leaves), "tree int, node long, rows binary, x binary, y binary, w binary")
    subtrees = materialize(rows.groupBy("tree", "node").applyInArrow(_subtree(params, d), _SUBTREE), "forest-subtrees")
    return RandomForestFit(params, d, list(zip(splits, leaves)), gains, subtrees)
