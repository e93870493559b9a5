"""Minority oversampling (SMOTE): new minority rows on the segment between a
minority row and one of its k nearest minority neighbours, until the
classes are equal.

Neighbours are exact and found on the executors. Points are cut into cells by halving a bounded sample
(``SAMPLE`` points a cell, the only rows the driver sees) at the median of its widest feature; a cell is one chunk
of rows, or several of at most about ``CHUNK_ROWS``; cells next to each other form groups of at most ``GROUP_ROWS``. A row's k-th distance within its own
group is a bound: its group needs another chunk only if that chunk's box reaches within the bound of a row. Rows stay
in their group's task and the chunks come to it, nearest first, each once for the whole group, so what is sent
grows with chunks times groups, not with rows times chunks, and only a row's k nearest ever leave the task. There
a chunk is cut into leaves of ``LEAF_ROWS``, which only rows within reach of their boxes meet, by one matrix product with
a stated rounding allowance; what may be near enough is scored again exactly. No join emits pairs of rows, no points
are broadcast. In many dimensions few boxes are out of reach and the work tends to O(m^2 / tasks), the cost of exact neighbours.

Synthesis is deterministic: row i makes floor(n_new / m) rows, plus one
for the (n_new mod m) rows with the smallest key hash; neighbour and gap of
copy j come from hashes of (id, j). A re-run, or a retried task, makes the
same rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmill.functions.exprs import HASH_SPACE
from tabmill.functions.quantiles import kth_smallest
from tabmill.session import materialize

CHUNK_ROWS = 8192
CELL_ROWS = 2048             # rows a cell holds on average, until there are MAX_PIVOTS cells
LEAF_ROWS = 512
MAX_PIVOTS = 1024
SAMPLE = 16                  # sampled rows a cell
GROUP_ROWS = 262_144         # rows a task searches for at once, with their k nearest
GROUP_VALUES = 24_000_000    # numbers it holds of them
BLOCK_CELLS = 4_000_000      # query rows x leaf rows scored at once per task
SEED = 42


def _hash_u(parts: list) -> F.Column:
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").cast("double") / F.lit(HASH_SPACE)


def _cuts(sample: np.ndarray, n: int) -> list[tuple[int, float, int, int]]:
    """A tree of ``n`` cells at most: (feature, cut, node up to the cut, node above it) by node, feature -1 for a cell."""
    nodes: list = [None]
    todo = [(0, np.arange(len(sample)), n)]
    while todo:
        at, rows, n = todo.pop()
        part = sample[rows]
        j = int(part.std(axis=0).argmax()) if len(rows) else 0
        values = np.sort(part[:, j])
        cut = values[len(rows) * (n // 2) // n - 1] if n > 1 and len(rows) > 1 else np.inf
        low = part[:, j] <= cut
        if n < 2 or low.all() or not low.any():
            nodes[at] = (-1, 0.0, at, at)
            continue
        nodes[at] = (j, float(cut), len(nodes), len(nodes) + 1)
        todo += [(len(nodes) + 1, rows[~low], n - n // 2), (len(nodes), rows[low], n // 2)]
        nodes += [None, None]
    return nodes


def _in_order(cuts: list[tuple[int, float, int, int]]) -> list[int]:
    """Cells from left to right."""
    todo, out = [0], []
    while todo:
        at = todo.pop()
        if cuts[at][0] < 0:
            out.append(at)
        else:
            todo += [cuts[at][3], cuts[at][2]]
    return out


def _assign(cuts: list[tuple[int, float, int, int]], d: int):
    """Cell of every point."""
    feature, cut, low, high = (np.array(c) for c in zip(*cuts, strict=True))

    def run(batches):
        for batch in batches:
            vec = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, d)
            cell = np.zeros(len(vec), np.int64)
            while len(go := np.flatnonzero(feature[cell] >= 0)):
                at = cell[go]
                cell[go] = np.where(vec[go, feature[at]] > cut[at], high[at], low[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["id", "vec", "cell"])
    return run


def knn_self(points: DataFrame, id_col: str, feats: list[str], k: int,
             chunk_rows: int = CHUNK_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(id, nb_rank, nb_id, dist, nb_vec) for the k nearest other rows of
    ``points`` by squared Euclidean distance; ties go to the smaller id. ``id_col`` is of any type."""
    spark, d = points.sparkSession, len(feats)
    pts = materialize(points.select(F.col(id_col).alias("id"), F.array(*[F.col(c).cast("double") for c in feats]).alias("vec")), "points")
    id_type = pts.schema["id"].dataType.simpleString()
    out = f"id {id_type}, nb_rank int, nb_id {id_type}, dist double, nb_vec array<double>"
    m = pts.count()
    if not m or k < 1:
        return spark.createDataFrame([], out)
    n_cells = max(1, min(max_pivots, math.ceil(m / min(chunk_rows, CELL_ROWS))))
    sample = np.array([r["vec"] for r in pts.orderBy(F.xxhash64("id"), "id").limit(SAMPLE * n_cells).collect()], float).reshape(-1, d)
    cuts = _cuts(sample, n_cells)
    celled = pts.mapInArrow(_assign(cuts, d), f"id {id_type}, vec array<double>, cell int")
    cells = {r["cell"]: (r["n"], math.ceil(r["n"] / chunk_rows)) for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    most = max(1, min(GROUP_ROWS, GROUP_VALUES // (d * (k + 1)), max(chunk_rows, math.ceil(m / spark.sparkContext.defaultParallelism))))
    place, rows = [], 0
    for c in (c for c in _in_order(cuts) if c in cells):
        n, subs = cells[c]
        for sub in range(subs):
            rows += n / subs
            place.append((c, sub, int((rows - 1) // most)))
    n_groups = place[-1][2] + 1
    chunks = spark.createDataFrame([(c, subs) for c, (_, subs) in cells.items()], "cell int, subs int")
    groups = spark.createDataFrame(place, "cell int, sub int, grp int")
    packed = (celled.join(chunks, "cell").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int"))
              .groupBy("cell", "sub").agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("vec")).alias("vecs"))
              .join(groups, ["cell", "sub"]).select("cell", "sub", "grp", "ids", "vecs"))
    own = materialize(packed.repartitionById(n_groups, F.col("grp")).sortWithinPartitions("grp", "cell", "sub").mapInArrow(
        _own_group(k, d), f"cell int, sub int, grp int, ids array<{id_type}>, vecs array<double>, bounds array<double>, "
                          "low array<double>, high array<double>"), "chunks")
    boxes = {(r["cell"], r["sub"]): (r["low"], r["high"]) for r in own.select("cell", "sub", "low", "high").collect()}
    needs = (visits(own, boxes, cells, chunks, d).select("grp", "cell", "sub", "gap")
             .unionByName(own.select("grp", "cell", "sub", F.lit(-1.0).alias("gap")))
             .groupBy("grp", "cell", "sub").agg(F.min("gap").alias("gap")))
    needs = materialize(needs, "needs")
    asking = own.select("grp", F.lit(-2.0).alias("gap"), "cell", "sub", "ids", "vecs", "bounds")
    asked = own.drop("grp").join(needs, ["cell", "sub"]).select(
        "grp", "gap", "cell", "sub", "ids", "vecs", F.lit(None).cast("array<double>").alias("bounds"))
    near = (asking.unionByName(asked).repartitionById(n_groups, F.col("grp")).sortWithinPartitions("grp", "gap", "cell", "sub")
            .mapInArrow(_search(k, d), out))
    if pts.groupBy("id").count().where("count > 1").isEmpty():
        return near
    # rows of one id share its ranks
    w = Window.partitionBy("id").orderBy("dist", "nb_id")
    return near.withColumn("nb_rank", F.row_number().over(w)).where(F.col("nb_rank") <= k)


def visits(own: DataFrame, boxes: dict[tuple[int, int], tuple[list, list]], cells: dict[int, tuple], chunks: DataFrame, d: int) -> DataFrame:
    """(grp, cell, sub, gap, ids): rows of a chunk of the group that come within their bounds of the box of another chunk
    (cell, sub), and the smallest squared distance to it. ``boxes``: ends by chunk; ``cells``, ``chunks``: rows and chunks by cell."""
    named = sorted(boxes)
    lows, highs = (np.array([boxes[c][i] for c in named], float).reshape(-1, d) for i in (0, 1))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, bounds = batch.column("ids")[i].values, batch.column("bounds")[i].values.to_numpy()
                vec = batch.column("vecs")[i].values.to_numpy().reshape(-1, d)
                me = (batch.column("cell")[i].as_py(), batch.column("sub")[i].as_py())
                apart = _gap(vec.min(axis=0), lows, highs, vec.max(axis=0))
                found, gaps, gone = [], [], []
                for c in np.flatnonzero(_within(apart, bounds.max())):
                    gap = _gap(vec, lows[c], highs[c])
                    go = np.flatnonzero(_within(gap, bounds))
                    if len(go) and named[c] != me:
                        found.append(named[c])
                        gaps.append(gap[go].min())
                        gone.append(go)
                if found:
                    at = pa.array(np.cumsum([0, *map(len, gone)]), pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column("grp")[i].as_py()] * len(found), pa.int32()), pa.array([c for c, _ in found], pa.int32()),
                        pa.array([sub for _, sub in found], pa.int32()), pa.array(gaps, pa.float64()),
                        pa.ListArray.from_arrays(at, ids.take(pa.array(np.concatenate(gone))))], ["grp", "cell", "sub", "gap", "ids"])

    kind = own.schema["ids"].dataType.simpleString()
    return own.select("cell", "sub", "grp", "ids", "vecs", "bounds").mapInArrow(run, f"grp int, cell int, sub int, gap double, ids {kind}")


#: Allowance of distances for the rounding of their sums.
SLACK = 1e-9


def _gap(low, lows, highs, high=None):
    """Squared distance of points (of boxes, if ``high`` is given) to boxes."""
    off = np.maximum(np.maximum(lows - (low if high is None else high), low - highs), 0)
    return (off * off).sum(axis=-1)


def _within(gap, bound):
    return gap * (1 - SLACK) <= bound * (1 + SLACK)


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _leaves(vec: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers by leaf: halves at the median of the widest feature, until at most ``size`` rows are left."""
    todo, done = [np.arange(len(vec))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        part = vec[rows]
        half = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], len(rows) // 2)
        todo += [rows[half[:len(rows) // 2]], rows[half[len(rows) // 2:]]]
    return done


def _in_leaf(q, code, bound, ref, ref_code, k):
    """(rows of q, rows of ref, distance): of the leaf ``ref`` at least those of a row's k nearest that are within ``bound``
    (squared). Where a bound is infinite it becomes, in place, one that k rows of the leaf keep."""
    centre = ref.mean(axis=0)
    go = np.flatnonzero(_within(_gap(q, ref.min(axis=0), ref.max(axis=0)), bound))
    r, x = ref - centre, q - centre
    r2, x2 = (r * r).sum(axis=1), (x * x).sum(axis=1)
    found = []
    step = max(1, BLOCK_CELLS // len(ref))
    for at in (go[s:s + step] for s in range(0, len(go), step)):
        rough = x2[at, None] + r2 - 2 * (x[at] @ r.T)
        err = 16 * (q.shape[1] + 8) * np.finfo(float).eps * (x2[at] + r2.max())   # of sums and product, generously
        far = np.flatnonzero(np.isinf(bound[at]))
        if len(far) and len(ref) > k:
            others = np.where(code[at[far], None] == ref_code, np.inf, rough[far])
            bound[at[far]] = np.maximum(np.partition(others, k - 1, axis=1)[:, k - 1] + err[far], 0)
        rows, cols = np.nonzero(rough <= (bound[at] * (1 + SLACK) + err)[:, None])
        rows = at[rows]
        other = code[rows] != ref_code[cols]                       # not its own neighbour
        rows, cols = rows[other], cols[other]
        dist = np.zeros(len(rows))
        for j in range(q.shape[1]):  # feature by feature, left to right: the same sum SQL writes
            diff = q[rows, j] - ref[cols, j]
            dist += diff * diff
        found.append(_first_k(rows, cols, dist, ref_code[cols], k))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _first_k(rows, cols, dist, code, k):
    """Of each row the k with the smallest (distance, code)."""
    if code.dtype == object:
        code = np.unique(code, return_inverse=True)[1]
    order = np.lexsort((code, dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    nth = _nth(rows)
    return rows[nth < k], cols[nth < k], dist[nth < k]


def _nth(rows):
    """How many equal numbers stand before each of the sorted ``rows``."""
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
    return np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))


def _codes(ids: pa.Array) -> np.ndarray:
    """Values that compare as the ids do."""
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return ids.to_numpy()
    out = np.empty(len(ids), object)
    out[:] = ids.to_pylist()
    return out


class _Group:
    """Rows of a group with the nearest found so far, ordered by leaf."""

    def __init__(self, ids: pa.Array, vec: np.ndarray, bound: np.ndarray | None, k: int):
        leaves = _leaves(vec, max(LEAF_ROWS, 4 * k))
        order = np.concatenate(leaves)
        ends = np.cumsum([0, *map(len, leaves)])
        self.leaves = [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.order, self.ids, self.vec, self.code, self.k = order, ids.take(pa.array(order)), vec[order], _codes(ids)[order], k
        self.lows = np.array([self.vec[at].min(axis=0) for at in self.leaves])
        self.highs = np.array([self.vec[at].max(axis=0) for at in self.leaves])
        self.bound = np.full(len(vec), np.inf) if bound is None else bound[order]
        if bound is None:
            for at in self.leaves:
                _in_leaf(self.vec[at], self.code[at], self.bound[at], self.vec[at], self.code[at], k)
        self.reach = np.array([self.bound[at].max() for at in self.leaves])
        self.held = np.zeros(len(vec), int)
        self.dist = np.full((len(vec), k), np.inf)
        self.near = np.empty((len(vec), k), self.code.dtype)
        self.at = np.zeros((len(vec), k, vec.shape[1]))

    def meet(self, code: np.ndarray, ref: np.ndarray) -> None:
        for leaf in _leaves(ref, max(LEAF_ROWS, 4 * self.k)):
            part, low, high = ref[leaf], ref[leaf].min(axis=0), ref[leaf].max(axis=0)
            for n in np.flatnonzero(_within(_gap(self.lows, low, high, self.highs), self.reach)):
                at = self.leaves[n]
                rows, cols, dist = _in_leaf(self.vec[at], self.code[at], self.bound[at], part, code[leaf], self.k)
                if len(rows):
                    self._keep(rows + at.start, code[leaf][cols], part[cols], dist)
                    self.reach[n] = self.bound[at].max()

    def _keep(self, rows, code, vec, dist) -> None:
        seen = np.unique(rows)
        old, nth = np.nonzero(np.arange(self.k) < self.held[seen, None])
        old = seen[old]
        rows, code = np.r_[old, rows], np.r_[self.near[old, nth], code]
        vec, dist = np.r_[self.at[old, nth], vec], np.r_[self.dist[old, nth], dist]
        rows, cols, dist = _first_k(rows, np.arange(len(rows)), dist, code, self.k)
        nth = _nth(rows)
        self.near[rows, nth], self.at[rows, nth], self.dist[rows, nth] = code[cols], vec[cols], dist
        self.held[rows] = np.maximum(self.held[rows], nth + 1)
        full = seen[self.held[seen] == self.k]
        self.bound[full] = np.minimum(self.bound[full], self.dist[full, self.k - 1])

    def found(self, rows: int = 8192):
        for s in range(0, len(self.vec), rows):
            at, nth = np.nonzero(np.arange(self.k) < self.held[s:s + rows, None])
            at += s
            yield pa.RecordBatch.from_arrays([
                self.ids.take(pa.array(at)), pa.array(nth + 1, pa.int32()), pa.array(self.near[at, nth], self.ids.type), pa.array(self.dist[at, nth]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * self.vec.shape[1], pa.int32()), pa.array(self.at[at, nth].ravel()))],
                ["id", "nb_rank", "nb_id", "dist", "nb_vec"])


def _vec(batch, i: int, d: int) -> np.ndarray:
    return batch.column("vecs")[i].values.to_numpy().reshape(-1, d)


def _own_group(k: int, d: int):
    """Chunks with their boxes and each row's bound, the k-th distance within the group's chunks."""
    def bounded(chunks):
        group = _Group(pa.concat_arrays([c.column("ids")[0].values for c in chunks]), np.concatenate([_vec(c, 0, d) for c in chunks]), None, k)
        for c in chunks:
            group.meet(_codes(c.column("ids")[0].values), _vec(c, 0, d))
        bounds = np.empty(len(group.vec))
        bounds[group.order] = np.where(group.held == k, group.dist[:, k - 1], np.inf)
        end = 0
        for c in chunks:
            vec = _vec(c, 0, d)
            start, end = end, end + len(vec)
            yield pa.RecordBatch.from_arrays(
                [*(c.column(x) for x in ("cell", "sub", "grp", "ids", "vecs")), *map(_one_list, map(pa.array, (bounds[start:end], vec.min(axis=0), vec.max(axis=0))))],
                ["cell", "sub", "grp", "ids", "vecs", "bounds", "low", "high"])

    def run(batches):
        held, grp = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                if held and batch.column("grp")[i].as_py() != grp:
                    yield from bounded(held)
                    held = []
                grp = batch.column("grp")[i].as_py()
                held.append(batch.slice(i, 1))
        if held:
            yield from bounded(held)
    return run


def _search(k: int, d: int):
    """The k nearest of each row of a group: its chunks come first, then those to be searched, nearest first."""
    def run(batches):
        asking, group, grp = [], None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if group is not None and batch.column("grp")[i].as_py() != grp:
                    yield from group.found()
                    asking, group = [], None
                grp = batch.column("grp")[i].as_py()
                if batch.column("gap")[i].as_py() == -2:
                    asking.append(batch.slice(i, 1))
                    continue
                if group is None:
                    group = _Group(pa.concat_arrays([c.column("ids")[0].values for c in asking]), np.concatenate([_vec(c, 0, d) for c in asking]),
                                   np.concatenate([c.column("bounds")[0].values.to_numpy() for c in asking]), k)
                group.meet(_codes(batch.column("ids")[i].values), _vec(batch, i, d))
        if group is not None:
            yield from group.found()
    return run


def smote(df: DataFrame, id_col: str, feats: list[str], label: str, k: int = 5,
          seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Oversample the minority class of ``df`` (binary ``label``) to the
    majority's size. Returns (synthetic rows, neighbours). Synthetic rows
    carry the minority label, ``source_id`` / ``copy`` (which row and which
    copy of it made them) and a NULL ``id_col``."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(counts) < 2:
        raise ValueError("SMOTE needs two classes")
    minority = min(counts, key=lambda c: (counts[c], c))
    n_min, n_maj = counts[minority], max(counts.values())
    n_new = n_maj - n_min
    k_eff = min(k, n_min - 1)
    mins = df.where(F.col(label) == F.lit(minority)).select(id_col, *feats)
    nbrs = knn_self(mins, id_col, feats, k_eff)
    syn = synthesize(mins, nbrs, id_col, feats, n_new, n_min, k_eff, seed)
    return syn.withColumn(label, F.lit(minority).cast(df.schema[label].dataType)), nbrs


def synthesize(mins: DataFrame, nbrs: DataFrame, id_col: str, feats: list[str],
               n_new: int, m: int, k: int, seed: int) -> DataFrame:
    base, extra = divmod(n_new, m)
    cut = None
    if extra:
        h = mins.select(_hash_u([F.col(id_col), F.lit(seed), F.lit("smote")]).alias("__u"))
        cut = kth_smallest(h, [], "__u", {(): [extra - 1]})[()][extra - 1]

    def copies(of: F.Column) -> F.Column:
        more = F.when(_hash_u([of, F.lit(seed), F.lit("smote")]) <= F.lit(cut), 1).otherwise(0) if cut is not None else F.lit(0)
        return F.lit(base) + more

    # a neighbour's rank says which copies take it, so only those go on to the join
    takes = F.floor(_hash_u([F.col("id"), F.lit(seed), F.lit("nb"), F.col("copy")]) * F.lit(float(k))) + 1 == F.col("nb_rank")
    n = copies(F.col("id"))
    taken = (nbrs.where(n > 0).select("id", "nb_rank", "nb_id", "nb_vec", F.explode(F.sequence(F.lit(0), n - 1)).alias("copy"))
             .where(takes).drop("nb_rank"))
    rows = mins.select(F.col(id_col).alias("__id"), F.array(*[F.col(c).cast("double") for c in feats]).alias("__x"),
                       copies(F.col(id_col)).alias("__n")).where(F.col("__n") > 0).drop("__n")
    rows = rows.join(taken, F.col("__id") == F.col("id"))
    gap = _hash_u([F.col("__id"), F.lit(seed), F.lit("gap"), F.col("copy")])
    new = F.zip_with("__x", "nb_vec", lambda a, b: a + gap * (b - a))
    out = rows.select(F.lit(None).cast(mins.schema[id_col].dataType).alias(id_col), F.col("__id").alias("source_id"), "copy",
                      F.col("nb_id").alias("neighbor_id"), gap.alias("gap"), new.alias("__v"))
    return out.select(id_col, "source_id", "copy", "neighbor_id", "gap",
                      *[F.col("__v")[i].alias(c) for i, c in enumerate(feats)])
