"""Gradient boosting on histograms: level-wise or leaf-wise trees, many models in one scan.

One pass over the blocks serves all models that grow at that time (the members of a vote; all draws and folds of a search):
for each of them a task adds up gradients, second derivatives and rows by (node, feature, bin), and Spark adds up the tasks'
histograms by (model, node) and picks the split there; the driver sees the splits alone, as many as trees have nodes.

Nodes of few rows need no pass of their own: their rows (bins and derivatives) meet in one task, which grows the rest of that
subtree by the same rules (there only the child with fewer rows is counted: its sibling is the parent's histogram less it).
``LOCAL_ROWS`` and ``LOCAL_BYTES`` bound such a task at any size of the table.

Leaf-wise trees are grown best split first, yet a level of passes at a time: a queue is played with the splits known so far,
all nodes it takes whose children are unknown are counted in one pass, and it is played again until it takes no such
node. The result is the tree that one pass per leaf would give, since a queue that knows more can only put off what it
took before.

A round is a few small jobs, so what a job costs beside its counting decides: histograms and rows travel as RDDs of arrays, not as
DataFrames planned anew for every pass, a stage needs one Python worker a task (a second one in it is started anew by every task),
and histograms are not carried to the next pass.

Blocks and scores are kept by the executors as large parts (memory, else disk) that every pass rereads; a round of many rows adds its trees
to the scores once, few rows wait for some rounds, during which the passes add them. Every ``KEEP_EVERY`` rounds blocks and scores are
written, which bounds what a lost executor costs. A model is at most rounds x leaves numbers, whatever the rows."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.session import materialize
from tabmill.trees.blocks import BLOCK_ROWS, Block, bin_edges, blocks, dealt, histogram, kept, part_rows, sides

KEEP_EVERY = 24
#: Trees that passes add to the scores of at most ``FEW_SCORES`` rows (of all models); more rows have theirs added after every round.
LATE_TREES, FEW_SCORES = 6, 1 << 20
#: Bytes of histograms that one task may hold: models beyond it grow in further passes.
TASK_BYTES = 96 << 20
#: A node with at most so many rows and bytes of bins and derivatives is finished in one task: what a task counts in less time
#: than a further pass over the table takes to start.
LOCAL_ROWS, LOCAL_BYTES = 1 << 18, 64 << 20


@dataclass(frozen=True)
class BoostParams:
    """``depth`` 0: no limit; ``leaves`` 0: level-wise, else best split first up to that many leaves. ``l2`` and ``l1`` act on
    leaf weights. ``newton``: splits by second derivatives; else by rows (the least squares fit of the gradients)."""
    rounds: int = 100
    rate: float = 0.3
    depth: int = 6
    leaves: int = 0
    l2: float = 0.0
    l1: float = 0.0
    min_rows: int = 1
    min_hessian: float = 0.0
    min_split: int = 2
    newton: bool = True

    def __post_init__(self):
        ok = (self.rounds >= 1 and self.rate > 0 and self.depth >= 0 and (self.leaves == 0 or self.leaves >= 2) and self.l2 >= 0 and self.l1 >= 0
              and self.min_rows >= 1 and self.min_hessian >= 0 and self.min_split >= 2 and (self.depth or self.leaves))
        if not ok:
            raise ValueError(f"boosting parameters out of range: {self}")


def gradients(kind: str, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """First and second derivatives of the loss (None: one everywhere)."""
    if kind == "regression":
        return score - y, None
    p = 1.0 / (1.0 + np.exp(-score))
    return p - y, np.maximum(p * (1.0 - p), 1e-16)


#: Gains this near to the best are equal to it, whatever the rounding.
SAME = 1 - 1e-9


def soft(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_split(hist: np.ndarray, p: BoostParams) -> tuple:
    """(feature, bin, gain, left sums, sums) of a node's histogram (3, features, bins); feature -1 without a split. Of equal
    gains the first feature and bin win."""
    total = hist[:, 0, :].sum(1)
    if total[2] < max(p.min_split, 2 * p.min_rows) or total[1] < 2 * p.min_hessian:
        return -1, 0, 0.0, np.zeros(3), total
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    ok = (left[2] >= p.min_rows) & (right[2] >= p.min_rows) & (left[1] >= p.min_hessian) & (right[1] >= p.min_hessian) & (total[2] >= p.min_split)
    by = 1 if p.newton else 2

    def quality(s):
        with np.errstate(divide="ignore", invalid="ignore"):
            return (soft(s[0], p.l1) if p.l1 else s[0]) ** 2 / (s[by] + p.l2)
    gain = np.where(ok, quality(left) + quality(right) - quality(total), -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain >= gain.max() * SAME)), gain.shape) if gain.size else (0, 0)
    if not gain.size or not gain[f, b] > 1e-10:
        return -1, 0, 0.0, np.zeros(3), total
    return int(f), int(b), float(gain[f, b]), left[:, f, b], total


@dataclass
class Node:
    sums: np.ndarray
    depth: int
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    left_sums: np.ndarray | None = None
    left: int = -1  # with the children counted: their places
    whole: bool = False  # all that may be split below is known


class Growing:
    """The tree a model grows in this round."""

    def __init__(self, params: BoostParams):
        self.p, self.nodes = params, []

    def add(self, sums, depth: int) -> int:
        self.nodes.append(Node(np.asarray(sums, float), depth))
        return len(self.nodes) - 1

    def found(self, node: int, feature: int, bin_: int, gain: float, left_sums) -> None:
        n = self.nodes[node]
        n.feature, n.bin, n.gain, n.left_sums = feature, bin_, gain, np.asarray(left_sums, float)

    def _splits(self, i: int) -> bool:
        n = self.nodes[i]
        return n.feature >= 0 and not (self.p.depth and n.depth >= self.p.depth)

    def chosen(self) -> list[int]:
        """The nodes that are split, as far as splits are known."""
        out, queue, leaves = [], [(-self.nodes[0].gain, 0)], 1
        while queue and not (self.p.leaves and leaves >= self.p.leaves):
            _, i = heapq.heappop(queue)
            if self._splits(i):
                out.append(i)
                leaves += 1
                if self.nodes[i].left >= 0:
                    for c in (self.nodes[i].left, self.nodes[i].left + 1):
                        heapq.heappush(queue, (-self.nodes[c].gain, c))
        return out

    def next_pass(self) -> list[tuple[int, int, int]]:
        """(node, child with fewer rows, its sibling) for the nodes whose children have to be known now."""
        out = []
        for i in self.chosen():
            n = self.nodes[i]
            if n.left >= 0 or n.whole or (self.p.depth and n.depth + 1 >= self.p.depth) or (self.p.leaves == 2):
                continue
            right_sums = n.sums - n.left_sums
            n.left = self.add(n.left_sums, n.depth + 1)
            self.add(right_sums, n.depth + 1)
            small, large = (n.left, n.left + 1) if n.left_sums[2] <= right_sums[2] else (n.left + 1, n.left)
            out.append((i, small, large))
        return out

    def finish(self, columns: np.ndarray, g: np.ndarray, h: np.ndarray | None, n_bins: int) -> np.ndarray:
        """Grows on the rows of the only node so far (``columns``: bins by feature); all nodes as rows of a matrix: feature, bin, gain, left, sums, left sums."""
        d = len(columns)

        def split(i, have):
            f, b, gain, left_sums, sums = best_split(have.reshape(3, d, n_bins), self.p)
            self.nodes[i].sums = sums
            self.found(i, f, b, gain, left_sums)
            hists[i] = have
        rows, hists = {0: None}, {}
        split(0, histogram(columns, None, g, h, n_bins))
        while todo := self.next_pass():
            for node, small, large in todo:
                n = self.nodes[node]
                rows[n.left], rows[n.left + 1] = sides(columns[n.feature], rows.pop(node), n.bin)
                have, part = hists.pop(node), histogram(columns, rows[small], g, h, n_bins)
                split(small, part)
                split(large, have - part)
        return np.array([[n.feature, n.bin, n.gain, n.left, *n.sums, *(n.left_sums if n.left_sums is not None else (0, 0, 0))] for n in self.nodes])

    def graft(self, at: int, found: np.ndarray) -> None:
        """Puts a subtree that ``finish`` grew in place of a node."""
        base, depth = len(self.nodes) - 1, {0: self.nodes[at].depth}
        for i, (feature, bin_, gain, left, *sums) in enumerate(found.tolist()):
            place = at if i == 0 else self.add(sums[:3], depth[i])
            n = self.nodes[place]
            n.sums = np.array(sums[:3])
            self.found(place, int(feature), int(bin_), gain, sums[3:])
            n.whole = True
            if left >= 0:
                n.left = int(left) + base
                depth[int(left)] = depth[int(left) + 1] = n.depth + 1

    def routes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, bin, left) of all nodes whose children are being counted."""
        f = [n.feature if n.left >= 0 else -1 for n in self.nodes]
        return np.array(f), np.array([n.bin for n in self.nodes]), np.array([n.left for n in self.nodes])

    def tree(self, edges: list[np.ndarray]) -> dict[str, np.ndarray]:
        """The finished tree: feature (-1: leaf), bin, threshold (left: at most), left, value (with the learning rate), gain."""
        p, split, rows = self.p, set(self.chosen()), []

        def weight(sums):
            return -p.rate * soft(sums[0], p.l1) / (sums[1] + p.l2) if sums[1] + p.l2 > 0 else 0.0
        todo = [(0, self.nodes[0].sums)]
        rows.append(None)
        at = 0
        while at < len(todo):
            i, sums = todo[at]
            if i is not None and i in split:
                n = self.nodes[i]
                rows[at] = (n.feature, n.bin, float(edges[n.feature][n.bin]), len(todo), 0.0, n.gain)
                children = (n.left, n.left + 1) if n.left >= 0 else (None, None)
                todo += [(children[0], n.left_sums), (children[1], n.sums - n.left_sums)]
                rows += [None, None]
            else:
                rows[at] = (-1, 0, 0.0, -1, weight(sums), 0.0)
            at += 1
        cols = list(zip(*rows))
        return {k: np.array(c, t) for k, c, t in zip(("feature", "bin", "threshold", "left", "value", "gain"), cols, (np.int64, np.int64, float, np.int64, float, float))}


def _leaf(values: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    at = np.zeros(len(values), np.int64)
    while True:
        f = feature[at]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return at
        a = at[inner]
        at[inner] = left[a] + (values[inner, f[inner]] > cut[a])


# ---- passes ----

_STATE = "pair int, fit boolean, n int, bins binary, y binary, scores binary"


def _joined(d: int, places: dict[int, tuple[int, int]], late: list[dict[int, dict]]):
    """The blocks as parts, with the late trees in their scores: bins by feature, targets, scores by model."""
    models: dict[int, int] = {}
    for pair, _ in places.values():
        models[pair] = models.get(pair, 0) + 1
    most = {pair: part_rows(d + 8 + 8 * n) for pair, n in models.items()}

    def joined(pair: int, fit: bool, some: list[Block]) -> dict:
        part = {"pair": pair, "fit": fit, "columns": np.concatenate([b.bins.T for b, _ in some], axis=1), "y": np.concatenate([b.y for b, _ in some]),
                "scores": np.concatenate([s for _, s in some], axis=1)}
        return {**part, "scores": _scores(part, places, late)}

    def run(records: Iterator) -> Iterator[dict]:
        held: dict[tuple[int, bool], list] = {}
        for record in map(lambda r: r.asDict(), records):
            key = record["pair"], record["fit"]
            some = held.setdefault(key, [])
            some.append((Block(record, d), np.frombuffer(record["scores"], np.float64).reshape(-1, record["n"])))
            if sum(b.n for b, _ in some) + BLOCK_ROWS > most[key[0]]:
                yield joined(*key, held.pop(key))
        for key, some in held.items():
            yield joined(*key, some)
    return run


def _at(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, wanted: list[int] | None = None) -> Iterator[tuple[int, np.ndarray | None]]:
    """(leaf, its rows, None for all), of the ``wanted`` leaves alone if given; leaves without rows are left out."""
    feature, cut, left = (v.tolist() for v in (feature, cut, left))
    need = [wanted is None] * len(feature)
    for i in wanted or []:
        need[i] = True
    for i in range(len(feature) - 1, -1, -1):  # children come after their parent
        need[i] = need[i] or (feature[i] >= 0 and (need[left[i]] or need[left[i] + 1]))
    todo: list[tuple[int, np.ndarray | None]] = [(0, None)]
    while todo:
        i, rows = todo.pop()
        if not need[i] or (rows is not None and not len(rows)):
            continue
        if feature[i] < 0:
            yield i, rows
        else:
            low, high = sides(columns[feature[i]], rows, cut[i])
            todo += [(left[i] + 1, high), (left[i], low)]


def _scores(part: dict, places: dict[int, tuple[int, int]], late: list[dict[int, dict]]) -> np.ndarray:
    """The scores of a part's rows by its pair's models (rows of the matrix), with the trees grown since they were kept."""
    if not late:
        return part["scores"]
    scores = part["scores"].copy()
    for trees in late:
        for m, t in trees.items():
            if places[m][0] == part["pair"]:
                mine = scores[places[m][1]]
                for leaf, rows in _at(part["columns"], t["feature"], t["bin"], t["left"]):
                    mine[slice(None) if rows is None else rows] += t["value"][leaf]
    return scores


def _count(kind: str, d: int, bins: int, places: dict[int, tuple[int, int]], late: list, routes: dict, targets: dict[int, list[int]]):
    """Histograms (three by features by bins) of every model's target nodes, one record per task, model and node."""
    def run(parts: Iterator[dict]) -> Iterator[tuple]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for part in parts:
            mine = [m for m in targets if places[m][0] == part["pair"]] if part["fit"] else []
            scores = _scores(part, places, late) if mine else None
            for m in mine:
                g, h = gradients(kind, part["y"], scores[places[m][1]])
                for i, rows in _at(part["columns"], *routes[m], targets[m]):
                    found = histogram(part["columns"], rows, g, h, bins)
                    sums[m, i] = sums[m, i] + found if (m, i) in sums else found
        yield from sums.items()
    return run


def _rows(kind: str, d: int, places: dict[int, tuple[int, int]], late: list, routes: dict, targets: dict[int, list[int]]):
    """The rows of the target nodes of every model: bins by feature and derivatives."""
    def run(parts: Iterator[dict]) -> Iterator[tuple]:
        for part in parts:
            mine = [m for m in targets if places[m][0] == part["pair"]] if part["fit"] else []
            scores = _scores(part, places, late) if mine else None
            for m in mine:
                g, h = gradients(kind, part["y"], scores[places[m][1]])
                for i, rows in _at(part["columns"], *routes[m], targets[m]):
                    some = slice(None) if rows is None else rows
                    yield (m, i), (part["columns"][:, some], g[some], None if h is None else h[some])
    return run


def _finish(d: int, bins: int, params: list[BoostParams], depths: dict[tuple[int, int], int]):
    """The subtree of the node whose rows are a partition (one node each)."""
    def run(parts: Iterator[tuple]) -> Iterator[tuple]:
        by: dict[tuple[int, int], list] = {}
        for key, part in parts:
            by.setdefault(key, []).append(part)
        for key, some in by.items():
            columns, g = np.concatenate([p[0] for p in some], axis=1), np.concatenate([p[1] for p in some])
            h = None if some[0][2] is None else np.concatenate([p[2] for p in some])
            order = np.argsort(g) if h is None else np.lexsort((h, g))  # sums do not depend on which block came first
            growing = Growing(params[key[0]])
            growing.add(np.zeros(3), depths[key])
            yield key, growing.finish(columns[:, order], g[order], None if h is None else h[order], bins)
    return run


def _choose(d: int, bins: int, params: list[BoostParams]):
    """The splits of the nodes whose tasks' histograms are a partition."""
    def run(parts: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for key, part in parts:
            sums[key] = sums[key] + part if key in sums else part
        for key, hist in sums.items():
            yield key, best_split(hist.reshape(3, d, bins), params[key[0]])
    return run


def _add_trees(places: dict[int, tuple[int, int]], late: list[dict[int, dict]]):
    """The parts with the late trees in their scores."""
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            yield {**part, "scores": _scores(part, places, late)}
    return run


def _blocks(parts: Iterator[dict]) -> Iterator[tuple]:
    """The parts as blocks again, to be written."""
    for part in parts:
        for i in range(0, len(part["y"]), BLOCK_ROWS):
            at = slice(i, i + BLOCK_ROWS)
            y = part["y"][at]
            yield part["pair"], part["fit"], len(y), bytearray(part["columns"][:, at].T.tobytes()), bytearray(y.tobytes()), bytearray(part["scores"][:, at].tobytes())


def _errors(places: dict[int, tuple[int, int]], late: list):
    """Per model and task, of the parts outside the fit rows: rows, squared error, and true positives, false ones, misses of class 1."""
    def run(parts: Iterator[dict]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            if part["fit"]:
                continue
            y, scores = part["y"], _scores(part, places, late)
            for m in [m for m, (pair, _) in places.items() if pair == part["pair"]]:
                s = scores[places[m][1]]
                yes, one = s > 0, y == 1
                found = np.array([len(y), ((s - y) ** 2).sum(), (yes & one).sum(), (yes & ~one).sum(), (~yes & one).sum()], float)
                sums[m] = sums[m] + found if m in sums else found
        yield from sums.items()
    return run


@dataclass
class BoostingFit:
    kind: str
    params: BoostParams
    base: float
    d: int
    trees: list[dict] = field(default_factory=list)

    @property
    def importances(self) -> np.ndarray:
        """Per feature: its share of all gains."""
        gains = sum((np.bincount(t["feature"][t["feature"] >= 0], t["gain"][t["feature"] >= 0], self.d) for t in self.trees), np.zeros(self.d))
        return gains / gains.sum() if gains.sum() > 0 else gains

    def nodes(self, number: int) -> list[tuple]:
        """A tree's nodes: (number from 1, children 2n and 2n + 1; feature, threshold, gain of a split; value of a leaf)."""
        t, out, todo = self.trees[number], [], [(0, 1)]
        while todo:
            i, name = todo.pop()
            if t["feature"][i] < 0:
                out.append((name, None, None, None, float(t["value"][i])))
            else:
                out.append((name, int(t["feature"][i]), float(t["threshold"][i]), float(t["gain"][i]), None))
                todo += [(int(t["left"][i]), 2 * name), (int(t["left"][i]) + 1, 2 * name + 1)]
        return out

    def score(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the prediction (class 1's probability for labels) in ``out``."""
        model = df.sparkSession.sparkContext.broadcast((self.kind, self.base, self.trees))
        return df.withColumn(out, _scorer(model)(vector_to_array("features")))


def _scorer(model):
    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        kind, base, trees = model.value
        if not len(features):
            return pd.Series([], dtype=float)
        x = np.stack(features.to_numpy())
        total = np.full(len(x), base)
        for t in trees:
            total += t["value"][_leaf(x, t["feature"], t["threshold"], t["left"])]
        return pd.Series(total if kind == "regression" else 1.0 / (1.0 + np.exp(-total)))
    return score


def _start(df: DataFrame, edges: list[np.ndarray], pair: int, fit: bool, base: float, models: int) -> DataFrame:
    value = "".join(f"{b:02x}" for b in np.array([base]).tobytes())
    scores = F.expr(f"unhex(repeat('{value}', {models} * n))")
    return blocks(df, edges).select(F.lit(pair).alias("pair"), F.lit(fit).alias("fit"), "n", "bins", "y", scores.alias("scores"))


def fit_boosting(pairs: list[tuple[DataFrame, DataFrame | None]], models: list[tuple[int, BoostParams]], kind: str,
                 with_errors: bool = False) -> tuple[list[BoostingFit], list[dict]]:
    """``models``: (number of the pair it is fit on, parameters). ``pairs``: (rows to fit on, rows held out or None). All
    models grow together. Returns the fits and, ``with_errors``, each one's errors on the rows held out."""
    spark = pairs[0][0].sparkSession
    places, per_pair = {}, [0] * len(pairs)
    for m, (pair, _) in enumerate(models):
        places[m] = (pair, per_pair[pair])
        per_pair[pair] += 1
    params, edges, fits, parts = [p for _, p in models], {}, [], []
    bases, rows = {}, {}
    for i, (train, held) in enumerate(pairs):
        if not per_pair[i]:
            continue
        edges[i] = bin_edges(train)
        mean, rows[i] = train.agg(F.avg("y"), F.count("y")).first()
        mean = mean or 0.0
        bases[i] = mean if kind == "regression" else math.log(max(mean, 1e-12) / max(1.0 - mean, 1e-12))
        parts.append(_start(train, edges[i], i, True, bases[i], per_pair[i]))
        if held is not None and with_errors:
            parts.append(_start(held, edges[i], i, False, bases[i], per_pair[i]))
    d = len(next(iter(edges.values())))
    bins = 1 + max((len(e) for es in edges.values() for e in es), default=0)
    fits = [BoostingFit(kind, p, bases[pair], d) for pair, p in models]
    parallel = spark.sparkContext.defaultParallelism
    state = _parts(materialize(reduce(DataFrame.unionByName, parts).repartition(parallel), "boost-blocks"), d, places)
    n_scores = sum(rows[pair] for pair, _ in models)
    late: list[dict[int, dict]] = []
    for number in range(max(p.rounds for p in params)):
        growing = {m: Growing(p) for m, p in enumerate(params) if number < p.rounds}
        _grow(state, late, growing, kind, d, bins, places, params, rows)
        trees = {m: g.tree(edges[places[m][0]]) for m, g in growing.items()}
        for m, t in trees.items():
            fits[m].trees.append(t)
        late.append(trees)
        before = state
        if (number + 1) % KEEP_EVERY == 0:
            scored = state.mapPartitions(_add_trees(places, late)).mapPartitions(_blocks)
            state, late = _parts(materialize(spark.createDataFrame(scored, _STATE, verifySchema=False), "boost-scores"), d, places), []
        elif len(late) == LATE_TREES or n_scores > FEW_SCORES:
            state, late = kept(state.mapPartitions(_add_trees(places, late))), []
        if state is not before:
            before.unpersist()
    errors: list[dict] = []
    if with_errors:
        names = ("n", "sq", "tp", "fp", "fn")
        found = state.mapPartitions(_errors(places, late)).reduceByKey(np.add).collect()
        by = {m: dict(zip(names, v.tolist())) for m, v in found}
        errors = [by.get(m, {}) for m in places]
    state.unpersist()
    return fits, errors


def _parts(table: DataFrame, d: int, places: dict[int, tuple[int, int]]) -> RDD:
    """Written blocks as parts kept by the executors."""
    return kept(table.rdd.mapPartitions(_joined(d, places, [])))


def _grow(state: RDD, late: list, growing: dict[int, Growing], kind: str, d: int, bins: int, places: dict, params: list[BoostParams], n_rows: dict[int, int]) -> None:
    """Passes until every model's tree is known; the small nodes of all levels are finished together, after the last count."""
    few = min(LOCAL_ROWS, LOCAL_BYTES // (d + 16))
    for m, g in growing.items():
        g.add((0.0, 0.0, n_rows[places[m][0]]), 0)
    new = {m: [0] for m in growing}
    targets: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    while new or ends:
        for m, nodes in new.items():
            for i in nodes:
                (ends if growing[m].nodes[i].sums[2] <= few else targets).setdefault(m, []).append(i)
        if targets:
            _count_pass(state, late, growing, targets, kind, d, bins, places, params)
            targets = {}
        else:
            routes = {m: growing[m].routes() for m in ends}
            depths = {(m, i): growing[m].nodes[i].depth for m, nodes in ends.items() for i in nodes}
            keys = sorted(depths, key=lambda k: -growing[k[0]].nodes[k[1]].sums[2])  # the largest begin first, each in a task of its own
            rows = state.mapPartitions(_rows(kind, d, places, late, routes, ends)).partitionBy(len(keys), dealt(keys, len(keys)))
            for (m, node), found in rows.mapPartitions(_finish(d, bins, params, depths)).collect():
                growing[m].graft(node, found)
            ends = {}
        new = {m: nodes for m, g in growing.items() if (nodes := [c for _, *both in g.next_pass() for c in both])}


def _count_pass(state: RDD, late: list, growing: dict[int, Growing], targets: dict, kind: str, d: int, bins: int, places: dict, params: list[BoostParams]) -> None:
    """Counts the targets and notes the splits found."""
    passes: list[dict[int, list[int]]] = [{}]
    for m, nodes in targets.items():
        if passes[-1] and sum(map(len, [*passes[-1].values(), nodes])) * 3 * d * bins * 8 > TASK_BYTES:
            passes.append({})
        passes[-1][m] = nodes
    for some in passes:
        routes = {m: growing[m].routes() for m in some}
        keys = [(m, i) for m, nodes in some.items() for i in nodes]
        n = min(len(keys), state.context.defaultParallelism)
        parts = state.mapPartitions(_count(kind, d, bins, places, late, routes, some)).partitionBy(n, dealt(keys, n))
        for (m, node), (feature, bin_, gain, left_sums, sums) in parts.mapPartitions(_choose(d, bins, params)).collect():
            if node == 0:
                growing[m].nodes[0].sums = sums
            growing[m].found(node, feature, bin_, gain, left_sums)
