"""Feature tables as blocks of rows for the tree learners.

A block is one record of at most ``BLOCK_ROWS`` rows: the features as doubles, the same as bin numbers (one byte each), the
target, and a hash of every row. Blocks are written once and reread by every pass. Bins are quantiles of each feature that
one aggregate finds (sketches of fixed size); a feature with fewer values than bins has one bin per value."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 4096
BINS = 256
#: Accuracy of the quantile sketches: exact up to this many rows, ranks within 1/ACCURACY of the rows beyond.
ACCURACY = 100000
#: A part, blocks joined in a task, has at most so many rows and bytes.
PART_ROWS, PART_BYTES = 1 << 18, 32 << 20

_SCHEMA = "n int, x binary, bins binary, y binary, rows binary"


def n_features(df: DataFrame) -> int:
    meta = df.schema["features"].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    first = df.select(F.size(vector_to_array("features")).alias("d")).first()
    return int(first["d"]) if first else 0


def bin_edges(df: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the rising upper bounds of all bins but the last; a value is in the bin of the first bound it does not
    exceed."""
    d = n_features(df)
    xs = df.select(vector_to_array("features").alias("x"))
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cols = [F.percentile_approx(F.get("x", F.lit(i)), probs, ACCURACY).alias(f"q{i}") for i in range(d)]
    top = [F.max(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(d)]
    row = xs.agg(*cols, *top).first()
    return [np.array(sorted({v for v in (row[f"q{i}"] or []) if v < row[f"m{i}"]})) for i in range(d)]


def _row_hash(df: DataFrame):
    """A hash of the row's plain columns, the same however the rows are dealt."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def arrays(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(name)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], "left")
    return out


def _pack(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = arrays(batch, "x"), batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            h = batch.column("h").to_numpy(zero_copy_only=False)
            for i in range(0, len(y), BLOCK_ROWS):
                part = np.ascontiguousarray(x[i:i + BLOCK_ROWS])
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([len(part)], pa.int32()), "x": [part.tobytes()], "bins": [to_bins(part, edges).tobytes()],
                    "y": [y[i:i + BLOCK_ROWS].tobytes()], "rows": [h[i:i + BLOCK_ROWS].tobytes()]})
    return run


def blocks(df: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """The blocks of a frame with ``features`` and ``y`` (not yet written)."""
    rows = df.select(vector_to_array("features").alias("x"), F.col("y").cast("double").alias("y"), _row_hash(df).alias("h"))
    return rows.mapInArrow(_pack(edges), _SCHEMA)


class Block:
    """The arrays of one block record."""

    def __init__(self, record: dict, d: int):
        self.n = record["n"]
        self.y = np.frombuffer(record["y"], np.float64)
        self.bins = np.frombuffer(record["bins"], np.uint8).reshape(self.n, d)
        self.x = np.frombuffer(record["x"], np.float64).reshape(self.n, d) if "x" in record else None
        self.rows = np.frombuffer(record["rows"], np.uint64) if "rows" in record else None


def part_rows(row_bytes: int) -> int:
    return min(PART_ROWS, PART_BYTES // row_bytes)


def kept(parts: RDD) -> RDD:
    """Kept in memory, else on disk; what is lost comes from the written table again."""
    parts.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    parts._jrdd.count()  # a job of its own: passes on top would need a second Python worker a task
    return parts


def dealt(keys: list, parts: int) -> Callable:
    """A partition function: the keys in turn."""
    places = {key: i % parts for i, key in enumerate(keys)}
    return places.__getitem__


def sides(column: np.ndarray, rows: np.ndarray | None, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows (None: all) with bins up to the cut and above it."""
    right = (column if rows is None else column[rows]) > int(cut)
    return (np.flatnonzero(~right), np.flatnonzero(right)) if rows is None else (rows[~right], rows[right])


def histogram(columns: np.ndarray, rows: np.ndarray | None, g: np.ndarray, h: np.ndarray | None, bins: int) -> np.ndarray:
    """Sums of two values of a row (``h``: None for ones) and rows, by features and bins, of some rows (None: all); ``columns``: bins by feature."""
    out = np.empty((3, len(columns), bins))
    if rows is not None:
        g, h = g[rows], None if h is None else h[rows]
    for f, column in enumerate(columns):
        at = (column if rows is None else column[rows]).astype(np.intp)
        out[2, f] = np.bincount(at, minlength=bins)
        out[0, f] = np.bincount(at, g, bins)
        out[1, f] = out[2, f] if h is None else np.bincount(at, h, bins)
    return out.reshape(3, -1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
