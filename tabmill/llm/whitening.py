"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, x = floor(64 c) + 1,000,000. Two passes over the vectors fit the model: exact sums of x, then
the scatter of x centred on the rounded mean, of which the rest of the mean is taken off. The products of the second pass are
of small whole numbers, so as long as they stay below 2^53 the scatter is exact and does not depend on how the rows are dealt.
Each task sums its rows and sends one row per dimension; the driver holds a square of the dimension, whatever the rows.

Pivoted Cholesky writes the scatter as L L' with the largest remaining diagonal entry first; it stops where what remains is
rounding, which is the rank. One-sided Jacobi turns pairs of columns of L until all are orthogonal: their squared norms are
the eigenvalues, the normalised columns (rows put back in order) the components. A third pass measures the covariance of the
whitened vectors, a fourth puts them out.

Defined results: vectors that are null, empty, or hold null or non-finite entries take no part; of vectors of different
lengths the most frequent length (of equally frequent ones the longest) does. Components without variance (a constant
table, one vector, fewer vectors than dimensions) have no rows. Entries whose x is beyond 2^62 count as that bound. A
deviation beyond 64 bits is null. vec_id may be null or repeated. Other columns are not read, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries of vectors that a task turns into numbers at a time.
BLOCK = 1 << 20
_BOUND = 2 ** 62


def usable(vectors: DataFrame) -> DataFrame:
    """The vectors that take part, of one length."""
    e = F.col("embedding").cast("array<double>")
    ok = F.coalesce(~F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))
    rows = vectors.select("vec_id", e.alias("embedding")).where(ok & (F.size(e) > 0))
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("embedding") == (lengths[0]["d"] if lengths else 0))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, x as whole numbers) of at most ``BLOCK`` entries."""
    for batch in batches:
        lists = batch.column("embedding")
        if len(lists):
            c = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            step = max(1, BLOCK // c.shape[1])
            for i in range(0, len(lists), step):
                x = np.clip(np.floor(c[i:i + step] * SCALE), -_BOUND, _BOUND).astype(np.int64) + OFFSET
                yield batch.column("vec_id").slice(i, step), x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension: rows, and the sum of x in two halves, so that no sum leaves 64 bits."""
    n, low, high = 0, 0, 0
    for _, x in _blocks(batches):
        n, low, high = n + len(x), low + (x & 0xFFFFFFFF).sum(0), high + (x >> 32).sum(0)
    if n:
        d = len(low)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["i", "n", "low", "high"])


def _row_sums(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of the summed z'z of some blocks, one record each, with the sums of z as the last."""
    gram, total = 0.0, 0.0
    for z in blocks:
        gram, total = gram + z.T @ z, total + z.sum(0)
    if np.ndim(total):
        both = np.vstack([gram, total])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(both)), pa.int32()), pa.array([r.tobytes() for r in both], pa.binary())], ["i", "row"])


def _add_rows(table: pa.Table) -> pa.Table:
    rows = [np.frombuffer(r, np.float64) for r in table.column("row").to_pylist()]
    return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([np.sum(rows, axis=0).tobytes()], pa.binary())})


def _scatter(rows: DataFrame, blocks) -> tuple[np.ndarray, np.ndarray]:
    """(sum of z z', sum of z) of the blocks that ``blocks`` makes of the rows."""
    found = (rows.mapInArrow(lambda batches: _row_sums(blocks(batches)), "i int, row binary")
             .groupBy("i").applyInArrow(_add_rows, "i int, row binary").collect())
    both = np.array([np.frombuffer(r["row"], np.float64) for r in sorted(found, key=lambda r: r["i"])])
    return both[:-1], both[-1]


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L' to rounding; rows in the order of ``a``, one column per pivot, largest remaining variance first."""
    d = len(a)
    left, factor = np.diag(a).astype(float).copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = int(np.argmax(left))
        if not left[p] > least:
            return factor[:, :k]
        column = (a[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[left == 0.0] = 0.0  # earlier pivots: above the diagonal
        column[p] = np.sqrt(left[p])
        factor[:, k] = column
        left = np.maximum(left - column ** 2, 0.0)
        left[p] = 0.0
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor factor', by falling eigenvalue."""
    w = factor.copy()
    r = w.shape[1]
    for _ in range(sweeps):
        turned = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                a, b = w[:, i], w[:, j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= 1e-15 * np.sqrt(aa * bb):
                    continue
                turned = True
                zeta = (bb - aa) / (2.0 * ab)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                w[:, i], w[:, j] = c * (a - t * b), c * (b + t * a)
        if not turned:
            break
    norms = np.linalg.norm(w, axis=0)
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, w[:, order] / norms[order]


@dataclass
class Whitening:
    """A fitted model. ``sums``: exact sums of x; ``middle``: rounded means; ``rest``: means less ``middle``."""
    n: int
    sums: list[int]
    middle: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle).astype(np.float64) - self.rest) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, in whole numbers."""
        shift = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        z = x - self.middle
        most = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, shift), default=0)
        if most * most * max(len(shift), 1) < 2 ** 63:
            return ((self.n * z - np.array(shift, np.int64)) ** 2).sum(1).tolist()
        found = [sum((self.n * v - s) ** 2 for v, s in zip(row, shift)) for row in z.tolist()]
        return [v if v < 2 ** 63 else None for v in found]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of ``usable`` vectors; None without any."""
    sums = rows.mapInArrow(_sums, "i int, n long, low long, high long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high")).collect()
    if not sums:
        return None
    sums = sorted(sums, key=lambda r: r["i"])
    n, total = int(sums[0]["n"]), [int(r["low"]) + (int(r["high"]) << 32) for r in sums]
    middle = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    shift = [s - n * int(m) for s, m in zip(total, middle)]
    gram, _ = _scatter(rows, lambda batches: ((x - middle).astype(np.float64) for _, x in _blocks(batches)))
    rest = np.array([s / n for s in shift])
    scatter = gram - n * np.outer(rest, rest)
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter / n))
    trace = float(np.trace(scatter)) / n
    return Whitening(n, total, middle, rest, values[:components], vectors[:, :components], trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity."""
    if not len(model.values):
        return 0.0
    gram, total = _scatter(rows, lambda batches: (model.project(x) for _, x in _blocks(batches)))
    mean = total / model.n
    return float(np.abs(gram / model.n - np.outer(mean, mean) - np.eye(len(mean))).max())


_OUT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors)
    schema = _OUT.format(vectors.schema["vec_id"].dataType.simpleString())
    model = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained = identity_error(rows, model), model.values / model.trace if len(model.values) else model.values

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(model.values)
        for ids, x in _blocks(batches):
            k = len(x)
            each = np.repeat(np.arange(k), m)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.full(k * m, model.n, np.int64)),
                 pa.array(model.deviations(x), pa.int64()).take(pa.array(each)), pa.array(model.project(x).ravel()),
                 pa.array(np.tile(explained, k)), pa.array(np.full(k * m, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(out, schema)
