"""Byte-level BPE with a hierarchical-bitmap rank queue.

Text is split by the tokenizer's pattern; each pre-token's bytes are merged by rank. The queue has a bucket of
positions per merge rank and a bitmap of the ranks whose bucket is not empty, over which a second level says which words
hold a bit. Find-first-set on both levels gives the lowest rank in constant time; its bucket, a heap, gives the
leftmost position; an entry whose pair has changed since is stale and skipped. Pieces form a linked list,
so a merge costs constant work besides its two new pairs, and a pre-token of n bytes O(n log n), however long.

Vocabulary: a rank file of lines "base64 rank" (its path is a parameter). Workers read it once; pre-tokens met
before come from a cache of bounded size. The same text gives the same ids on any partitioning.

Defined results: a null text is an empty one: no ids, empty decoded bytes. Rows are independent, so repeated rows,
null ids and extra columns need no rule; texts with lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE = 800_000  # units in each of the two generations of a worker's cache, about 240 bytes each
_UNITS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to re, but not to the pattern


class BytePairEncoder:
    """Encoder and decoder of one vocabulary. The rank queue lives as long as the encoder: it is empty between two
    pre-tokens, so a pre-token pays for its own entries only."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.shift = (max(ranks.values()).bit_length() + 1) // 2  # two levels of words of 2^shift bits hold all ranks
        self.low = [0] * ((max(ranks.values()) >> self.shift) + 1)
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def load(path: str, pattern: str) -> BytePairEncoder:
        with open(path, "rb") as f:
            return BytePairEncoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        get, n = self.ranks.get, len(piece)
        if (whole := get(piece)) is not None:
            return [whole]
        low, shift, mask = self.low, self.shift, (1 << self.shift) - 1
        top = 0  # bit w: low[w] has a bit; bit b of low[w]: the rank of both has a bucket
        buckets: dict[int, list[int]] = {}
        end = list(range(1, n + 2))  # where the piece that begins here ends
        before = list(range(-1, n))  # where the piece before begins
        live: list[int | None] = [None] * (n + 1)  # rank of the pair that begins here; other queue entries are stale
        for i in range(n - 1):
            rank = get(piece[i:i + 2])
            if rank is not None:
                live[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # in order, hence a heap
                else:
                    buckets[rank] = [i]
                    word = rank >> shift
                    low[word] |= 1 << (rank & mask)
                    top |= 1 << word
        while top:
            word = (top & -top).bit_length() - 1  # find-first-set on either level
            bits = low[word]
            bit = bits & -bits
            rank = (word << shift) + bit.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                low[word] = bits = bits ^ bit
                if not bits:
                    top &= top - 1
            if live[i] != rank:
                continue
            j = end[i]
            k = end[j]
            end[i], live[j], live[i] = k, None, None
            before[k] = i
            h = before[i]
            if k < n:
                live[i] = rank = get(piece[i:end[k]])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        word = rank >> shift
                        low[word] |= 1 << (rank & mask)
                        top |= 1 << word
            if h >= 0:
                live[h] = rank = get(piece[h:k])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], h)
                    else:
                        buckets[rank] = [h]
                        word = rank >> shift
                        low[word] |= 1 << (rank & mask)
                        top |= 1 << word
        out, i = [], 0
        while i < n:
            j = end[i]
            out.append(get(piece[i:j]))
            i = j
        return out

    def _unit(self, unit: str) -> tuple[int, ...]:
        """Ids of a unit that the young cache lacks."""
        ids = self.old.get(unit)
        if ids is None:
            pieces = self.pattern.findall(unit)
            if len(pieces) == 1:
                ids = tuple(self.merge(unit.encode()))
            else:  # a word with a comma is often known without it
                found = (self.young.get(p) or self.old.get(p) or self.merge(p.encode()) for p in pieces)
                ids = tuple(x for known in found for x in known)
        if len(unit) <= 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[unit] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The pattern never matches across the end of a run of characters other than white space, nor before the space that
        precedes it, so such units are split off first and cached with the ids of all their pre-tokens."""
        young, out = self.young, []
        for unit in self.pattern.findall(text) if _SEPARATORS.search(text) else _UNITS.findall(text):
            ids = young.get(unit)
            if ids is None:
                ids = self._unit(unit)
                young = self.young
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> BytePairEncoder:
    return BytePairEncoder.load(path, pattern)


def encode_column(df: DataFrame, path: str, pattern: str, out: str = "ids") -> DataFrame:
    """``df`` with ``out``, the ids of ``text``; other columns are kept and may have any other name."""
    schema = df.drop(out).schema.add(out, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            ids = pa.array([bpe.encode(t or "") for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])

    return df.drop(out).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes the ids decode to)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        decimal = {i: str(i) for i in bpe.tokens}
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text or "")
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
