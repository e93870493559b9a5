"""Substring dedup: words inside windows that an earlier document already has are removed.

A window is ``width`` consecutive words of one document. Every window of every text gets a Rabin-Karp hash: words are
hashed by a polynomial over their bytes, windows by two independent polynomials over their words, all from prefix sums, so
the cost of a window does not depend on its width. A task counts the windows of a piece of the input: of those found in
several documents of the piece all but the one of the smallest doc_id are repeats already, and only that one is sent on.
So a window that a third of all documents hold reaches the shuffle once a piece. The rest is counted in Spark by bucket of
the hash; a bucket names the windows that also start in a document with a smaller doc_id, and these go back to their
documents (a row per bucket and group of documents), where overlapping windows merge into maximal intervals of removed words.

Whether a window is a repeat depends on its words and its doc_id alone, so only hashes and ids are shuffled, about ten
bytes a window. Two different windows are taken for one if the 64 bits of the first hash and the bucket, which the second
hash gives (some ten bits, one more with every doubling of the input), agree: one chance in 2,000 that any two of all the
windows of 30 GB of text do.

Defined results: a null text has no words. A document with a null doc_id removes nothing and keeps all its words. Rows
with one doc_id do not remove each other's words. Texts shorter than a window are kept. Other columns
are not read, whatever their names. An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 13
#: Text bytes a bucket of hashes stands for: some 2,500,000 windows, which one task sorts in about 150 MB.
BUCKET_BYTES = 16 << 20
#: Text bytes a task hashes at a time, and the most that word hashing looks at in one go (a longer word is one go).
PIECE_BYTES, SEGMENT_BYTES = 3 << 20, 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RNG = np.random.Generator(np.random.PCG64(20261))
_BYTE = _RNG.integers(1, 2 ** 64, 256, np.uint64)
_BASES = [int(b) | 1 for b in _RNG.integers(2 ** 60, 2 ** 64, 3, np.uint64)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse modulo 2^64 (at least ``n`` of each)."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 2 ** 64))]
        for s in steps:
            s[0] = 1
        _POWERS[base] = tuple(np.cumprod(s, dtype=np.uint64) for s in steps)
    return _POWERS[base]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads a 64-bit hash over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, max(len(values), 1))[0][:len(values)], dtype=np.uint64, out=out[1:])
    return out


def _spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word also ends where a text does (``cuts``, offsets into ``data``)."""
    inside = ~_SPACE[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    start[cuts] |= inside[cuts]
    end[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, hash) of every word of the texts in ``data``, hashed in segments that end between words."""
    places, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        stop = min(at + SEGMENT_BYTES, len(data))
        if stop < len(data):
            blanks, inner = np.flatnonzero(_SPACE[data[at:stop]]), cuts[(cuts > at) & (cuts <= stop)]
            if len(blanks) or len(inner):
                stop = max(at + int(blanks[-1]) + 1 if len(blanks) else 0, int(inner[-1]) if len(inner) else 0)
            else:  # one long word: to its end
                later = cuts[cuts > stop]
                limit = int(later[0]) if len(later) else len(data)
                while stop < limit and not _SPACE[data[stop]]:
                    stop += 1
        part = data[at:stop]
        s, e = _spans(part, cuts[(cuts > at) & (cuts < stop)] - at)
        sums = _prefix(_BYTE[part], _BASES[0])
        places.append(s + at)
        hashes.append(_mix((sums[e] - sums[s]) * _powers(_BASES[0], len(part))[1][s] + (e - s).astype(np.uint64)))
        at = stop
    return np.concatenate(places), np.concatenate(hashes)


class Piece:
    """The windows of some whole texts: ``first`` their word numbers, ``doc`` their texts, ``h`` and ``g`` their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        place, word = word_hashes(data, offsets)
        doc = np.searchsorted(offsets, place, "right") - 1
        self.words = np.bincount(doc, minlength=len(offsets) - 1)
        self.begin = np.concatenate([[0], np.cumsum(self.words)])
        n = max(len(word) - width + 1, 0)
        at = np.flatnonzero(doc[:n] == doc[width - 1:]) if n else np.zeros(0, np.int64)
        self.doc, self.first = doc[at], at - self.begin[doc[at]]
        self.h, self.g = (self._windows(values, base, at, width) for values, base in ((word, _BASES[1]), (_mix(word + np.uint64(1)), _BASES[2])))

    @staticmethod
    def _windows(values: np.ndarray, base: int, at: np.ndarray, width: int) -> np.ndarray:
        sums = _prefix(values, base)
        return _mix((sums[at + width] - sums[at]) * _powers(base, max(len(values), 1))[1][at])


def _pieces(batch: pa.RecordBatch, width: int, limit: int) -> Iterator[tuple[int, int, Piece]]:
    """(first row, end row, windows) of consecutive rows with at most ``limit`` bytes of text, a longer text alone."""
    text = batch.column("text")
    ends = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) else np.int64)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(text):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, end, Piece(data[ends[row]:ends[end]], ends[row:end + 1] - ends[row], width)
        row = end


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _small(values: np.ndarray) -> list[bytes]:
    """Whole numbers from 0 in as few bytes each as the largest needs, after their count and width."""
    width = next((w for w in (1, 2, 4) if int(values.max(initial=0)) < 1 << 8 * w), 8)
    return [np.array([len(values), width], np.uint32).tobytes(), values.astype(f"<u{width}").tobytes()]


def _take_small(blob: bytes, at: int) -> tuple[np.ndarray, int]:
    n, width = np.frombuffer(blob, np.uint32, 2, at).tolist()
    return np.frombuffer(blob, f"<u{width}", n, at + 8).astype(np.int64), at + 8 + n * width


def _pack_hashes(ids: np.ndarray, h: np.ndarray) -> bytes:
    """Hashes in the order of their documents' ids, as one value: ids by difference, entries of each, hashes."""
    begin = _runs(ids)
    gaps = np.diff(ids[begin].astype(np.uint64), prepend=ids[:1].astype(np.uint64))
    return b"".join([ids[:1].astype(np.int64).tobytes(), *_small(gaps), *_small(np.diff(np.append(begin, len(ids)))), h.tobytes()])


def _unpack_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    gaps, at = _take_small(blob, 8)
    counts, at = _take_small(blob, at)
    ids = np.frombuffer(blob, np.int64, 1) + np.cumsum(gaps)
    return np.repeat(ids, counts), np.frombuffer(blob, np.uint64, int(counts.sum()), at)


def _binary(data: np.ndarray, begin: np.ndarray) -> pa.Array:
    """``data`` cut at ``begin``, one binary value each."""
    ends = np.append(begin, len(data)) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _entries(width: int, buckets: int):
    """Of every piece: the hashes to be judged, by bucket; and under a bucket below 0, as (doc_id, k, first and end word
    numbers of runs of windows), those that the piece itself shows to be repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_all = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys_all = batch.column("k").to_numpy(zero_copy_only=False)
            for row, end, piece in _pieces(batch, width, PIECE_BYTES):
                if not len(piece.h):
                    continue
                keys = keys_all[row:end]
                bucket = ((piece.g >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((ids_all[row:end][piece.doc], bucket, piece.h))
                ids = ids_all[row:end][piece.doc[order]]
                begin = _runs(piece.h[order], bucket[order])
                least = np.repeat(ids[begin], np.diff(np.append(begin, len(order))))
                once = np.zeros(len(order), bool)
                once[begin] = True  # a text's own repeats are found again when its words are cut
                out = []
                pick = order[once]
                pick_ids = ids_all[row:end][piece.doc[pick]]
                sort = np.lexsort((pick_ids, bucket[pick]))
                pick, pick_ids = pick[sort], pick_ids[sort]
                cut = _runs(bucket[pick])
                for a, b in zip(cut, np.append(cut[1:], len(pick))):
                    out.append((int(bucket[pick[a]]), _pack_hashes(pick_ids[a:b], piece.h[pick[a:b]])))
                known = np.sort(order[ids > least])  # windows are in the order of their texts and words
                if len(known):
                    doc, first = piece.doc[known], piece.first[known]
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(first) != 1)]))
                    last = np.append(new[1:], len(known)) - 1
                    table = np.stack([ids_all[row:end][doc[new]], keys[doc[new]], first[new], first[last] + 1], 1).astype(np.int64)
                    out.append((-1 - int(pick_ids[0]) % buckets, table.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["bucket", "part"])
    return run


def _target(ids: np.ndarray, targets: int) -> np.ndarray:
    """Which group of documents an id belongs to."""
    return (_mix(ids.astype(np.uint64)) % np.uint64(targets)).astype(np.int64)


def _judge(targets: int):
    """The repeats of one bucket by group of documents: hashes, or (``known``) runs of windows."""
    def run(table: pa.Table) -> pa.Table:
        parts = [v.as_buffer() for v in table.column("part").combine_chunks()]
        known = table.column("bucket")[0].as_py() < 0
        if known:
            found = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 4) for p in parts])
            ids = found[:, 0]
        else:
            ids, h = (np.concatenate(c) for c in zip(*[_unpack_hashes(p) for p in parts]))
            order = np.argsort(h, kind="stable")
            begin = _runs(h[order])
            least = np.repeat(np.minimum.reduceat(ids[order], begin), np.diff(np.append(begin, len(h))))
            pick = order[ids[order] > least]
            ids, h = ids[pick], h[pick]
        target = _target(ids, targets)
        order = np.lexsort((ids, target))
        begin = _runs(target[order])
        pack = (lambda i: found[i].tobytes()) if known else (lambda i: _pack_hashes(ids[i], h[i]))
        cuts = np.split(order, begin[1:]) if len(order) else []
        return pa.table({"target": pa.array(target[order][begin], pa.int64()), "known": pa.array([known] * len(begin), pa.bool_()),
                         "part": pa.array([pack(c) for c in cuts], pa.binary())})
    return run


def _merge(table: pa.Table) -> pa.Table:
    """The marks of a group of documents, one row each: hashes (64 bits each), and runs as (k, first, end) of 64 bits each."""
    parts = {True: [], False: []}
    for known, part in zip(table.column("known").to_pylist(), table.column("part").combine_chunks()):
        parts[known].append(part.as_buffer())
    runs = np.concatenate([np.zeros((0, 4), np.int64), *[np.frombuffer(p, np.int64).reshape(-1, 4) for p in parts[True]]])
    pairs = [_unpack_hashes(p) for p in parts[False]]
    ids, h = (np.concatenate([np.zeros(0, t), *c]) for t, c in zip((np.int64, np.uint64), zip(*pairs) if pairs else ([], [])))
    by_id, by_run = np.argsort(ids, kind="stable"), np.argsort(runs[:, 0], kind="stable")
    docs = np.unique(np.concatenate([ids, runs[:, 0]]))
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "hashes": _binary(h[by_id], np.searchsorted(ids[by_id], docs)),
                     "runs": _binary(np.ascontiguousarray(runs[by_run, 1:]).view("V24").ravel(), np.searchsorted(runs[by_run, 0], docs))})


def _intervals(covered: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def _cut(width: int):
    """Every text without the words of its repeats. All windows of a text with the hash of a repeat are repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, words_of, spans, kept = batch.column("k").to_pylist(), [], [], []
            for row, end, piece in _pieces(batch, width, PIECE_BYTES):
                bounds = np.searchsorted(piece.doc, np.arange(end - row + 1))
                for i in range(row, end):
                    text, n = batch.column("text")[i].as_py(), int(piece.words[i - row])
                    words, gone = text.encode().split(), []
                    if batch.column("hashes")[i].is_valid:
                        h = piece.h[bounds[i - row]:bounds[i - row + 1]]
                        runs = np.frombuffer(batch.column("runs")[i].as_py(), np.int64).reshape(-1, 3)
                        known = [h[a:b] for k, a, b in runs.tolist() if k == own[i]]
                        repeats = np.concatenate([np.frombuffer(batch.column("hashes")[i].as_py(), np.uint64), *known])
                        begin = np.flatnonzero(np.isin(h, repeats))
                        change = np.bincount(begin, minlength=n + 1) - np.bincount(begin + width, minlength=n + 1)
                        covered = np.cumsum(change)[:n] > 0
                        gone, words = _intervals(covered), compress(words, (~covered).tolist())
                    words_of.append(n)
                    spans.append(gone)
                    kept.append(b" ".join(words).decode())
            removed = [sum(s["end"] - s["start"] for s in g) for g in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words_of, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "removed", "kept"])
    return run


def repeats(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, hashes, runs) of the documents with repeated windows, one row each: hashes of windows, and runs of windows
    (k, first, end) of the text with hash k."""
    texts = texts.where("doc_id is not null and text <> ''")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, targets = max(size // BUCKET_BYTES, 2 * partitions), max(size // (8 * BUCKET_BYTES), partitions)
    parts = texts.mapInArrow(_entries(width, buckets), "bucket long, part binary")
    found = parts.groupBy("bucket").applyInArrow(_judge(targets), "target long, known boolean, part binary")
    return found.groupBy("target").applyInArrow(_merge, "doc_id long, hashes binary, runs binary")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, removed (intervals of word numbers, end exclusive) and
    kept, the words left joined by one space."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("k", F.hash("text"))
    joined = texts.join(repeats(texts, width).hint("merge"), "doc_id", "left")
    return joined.select("doc_id", "text", "k", "hashes", "runs").mapInArrow(
        _cut(width), "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string")
