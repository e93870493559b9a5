"""Token counts by a map-side two-tier lookup, without shuffling a pre-token.

The tokenizer (a ``tokenizers`` JSON file; its path is a parameter) drops white space and never merges across it, so a
text's count is the sum of the counts of its white-space separated pre-tokens. First tier: a broadcast open-addressing
hash table, 64-bit hashes and one-byte lengths, of the most frequent pre-tokens of all documents (``TABLE_BITS`` bounds its
size). Second tier: a worker's bounded cache; what it lacks is encoded by the library itself, in batches.

Which pre-tokens are frequent is counted over every document: each task keeps a Misra-Gries summary of its own and hands on the
pre-tokens with at least one part in ``HANDED`` of its occurrences, and Spark adds these up; a sum is too low by two parts in ``KEEP``
of all occurrences at most. The table takes the most frequent by classes of sums (eight to a power of two), as many classes as it
has room for, so nothing is sorted in one task and ties are taken or left together. No pre-token is shuffled for a count, only these
summaries (a task of 128 MB hands on some 1 MB). The table decides only which tier answers, never a count. Pre-tokens of over ``LONGEST``
characters are left to the second tier.

A table entry stores the whole pre-token's 64-bit hash (xxh3), so a wrong answer needs two of a corpus's pre-tokens with one
hash.

Special strings inside a text count as the library's default does; a text with one of the separators 0x1C to 0x1F, which Python
splits at but the tokenizer does not, is encoded whole.

Defined results: a null text is an empty one (0 bytes, 0 tokens); rows are independent; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.common import Stages

TABLE_BITS, CACHE, LONGEST = 18, 300_000, 64
KEEP, HANDED = 1 << 18, 1 << 20
LIMIT = 2048
_SEPARATORS = re.compile("[\x1c-\x1f]")


class LengthTable:
    """Open addressing with linear probing over two arrays; length 0 marks a free slot."""

    def __init__(self, bits: int = TABLE_BITS):
        self.mask = (1 << bits) - 1
        self.keys, self.lengths = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint8)
        self.room = (1 << bits) // 2

    def put(self, key: int, length: int) -> None:
        i = key & self.mask
        while self.lengths[i] and self.keys[i] != key:
            i = (i + 1) & self.mask
        if not self.lengths[i] and self.room:
            self.keys[i], self.lengths[i] = key, length
            self.room -= 1

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Lengths, 0 where a key is not held; all keys probe together."""
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        out = np.zeros(len(keys), np.uint8)
        open_ = np.arange(len(keys))
        while len(open_):
            at = slot[open_]
            used = self.lengths[at] > 0
            hit = used & (self.keys[at] == keys[open_])
            out[open_[hit]] = self.lengths[at[hit]]
            open_ = open_[used & ~hit]
            slot[open_] = (slot[open_] + 1) & self.mask
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def lengths_by_library(path: str, texts: list[str]) -> list[int]:
    t = tokenizer(path)
    out: list[int] = []
    for i in range(0, len(texts), 2000):
        out += [len(e.ids) for e in t.encode_batch_fast(texts[i:i + 2000], add_special_tokens=False)]
    return out


class Summary:
    """Misra-Gries counts: of any number of occurrences N at most ``keep`` entries stay after a cut, and a count is too low by N / ``keep`` at
    most. Entries are cut by the ``keep``-th largest count when there are more than twice as many."""

    def __init__(self, keep: int):
        self.keep, self.total, self.counts = keep, 0, Counter()

    def add(self, pre_tokens: list[str]) -> None:
        self.total += len(pre_tokens)
        self.counts.update(pre_tokens)
        if len(self.counts) > 2 * self.keep:
            values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            cut = int(np.partition(values, -self.keep)[-self.keep])
            self.counts = Counter({w: n - cut for w, n in self.counts.items() if n > cut})


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    summary = Summary(KEEP)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            summary.add((text or "").split())
    least = summary.total / HANDED
    held = [(w, n) for w, n in summary.counts.items() if n >= least and len(w) <= LONGEST and not _SEPARATORS.search(w)]
    yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in held], pa.string()), "n": pa.array([n for _, n in held], pa.int64())})


def frequent_lengths(docs: DataFrame, path: str, bits: int = TABLE_BITS) -> LengthTable:
    """The table of the most frequent pre-tokens of all documents (see above)."""
    table = LengthTable(bits)
    stages = Stages(docs.sparkSession, "tokens")
    sums = docs.select("text").mapInArrow(_summaries, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    sums = stages.write(sums.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "frequent")
    fit, least = 0, None
    for r in sorted(sums.groupBy("class").count().collect(), key=lambda r: -r["class"]):  # 8 classes to a bit of the largest sum
        fit += r["count"]
        if fit > table.room:
            break
        least = r["class"]
    chosen = [] if least is None else sorted(r["word"] for r in sums.where(F.col("class") >= least).select("word").collect())
    stages.drop(sums)
    for w, n in zip(chosen, lengths_by_library(path, chosen), strict=True):
        if 0 < n < 256:
            table.put(xxhash.xxh3_64_intdigest(w), n)
    return table


def _counter(path: str, shared):
    cache: dict[str, int] = {}

    def lengths(pre_tokens: list[str]) -> dict[str, int]:
        """Of distinct pre-tokens."""
        found, rest = {}, []
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, pre_tokens), np.uint64, len(pre_tokens))
        for w, n in zip(pre_tokens, shared.value.get(keys).tolist(), strict=True):
            if n:
                found[w] = n
            else:
                rest.append(w)
        misses = [w for w in rest if w not in cache]
        if len(cache) + len(misses) > CACHE:
            cache.clear()
            misses = rest
        fresh = dict(zip(misses, lengths_by_library(path, misses), strict=True))
        cache.update((w, n) for w, n in fresh.items() if len(w) <= 64)
        found.update((w, fresh[w] if w in fresh else cache[w]) for w in rest)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [0] * len(texts)
            whole = [i for i, t in enumerate(texts) if _SEPARATORS.search(t)]
            for i, n in zip(whole, lengths_by_library(path, [texts[i] for i in whole]), strict=True):
                counts[i] = n
            odd, i = set(whole), 0
            while i < len(texts):  # as many texts at once as hold a bounded number of pre-tokens
                group, size = [], 0
                while i < len(texts) and size < 500_000:
                    if i not in odd:
                        group.append((i, texts[i].split()))
                        size += len(group[-1][1])
                    i += 1
                n = lengths(list(set(chain.from_iterable(w for _, w in group))))
                for k, w in group:
                    counts[k] = sum(map(n.__getitem__, w))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        yield from _counter(path, shared)(batches)

    return docs.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)
