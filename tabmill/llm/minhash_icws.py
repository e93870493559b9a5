"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text (lower case, ASCII white space collapsed) is its five-word shingles with weights tf * idf; a text of one to four
words is one shingle. Improved consistent weighted sampling (Ioffe 2010) draws N_BANDS * ROWS samples per text, where
two texts agree in a sample with a probability equal to their weighted Jaccard similarity. Texts that agree in all
samples of a band are candidates; candidates are verified on the whole weighted shingle sets, sum of minima over sum of
maxima >= 0.8, and verified links are joined into classes (connected components).

idf(s) = 1 + DAMP * ln(N / df(s)) / ln(N + 1), between 1 and 1 + DAMP: rare shingles count more, yet a large group of near
copies, whose shared shingles are frequent only because of the group, keeps its similarity. df counts all documents, in
2^DF_BITS hashed counters (a count sketch of one row: the mean load of a counter is subtracted), so what tasks and driver
hold is bounded by that parameter at any corpus size.

Candidates within a bucket of a band, without all pairs: texts equal after normalisation are one node (one row). Each
bucket's hub, its member with the most candidates overall, is compared with every member, in one join over the distinct
(member, hub) pairs of all bands. Buckets whose members are still in more than one component are then compared fully
between components: everything outside the bucket's largest component against the members of other components. Those
already connected need no comparison, so no link between classes is lost. That comparison runs inside tasks, in blocks of
``CELL`` rows by ``CELL`` rows, and emits no pair but the links it finds, one per text and component. A pair is looked at in the
first bucket it shares; first by its samples, of which at least ``MIN_AGREE`` must agree (a pair at similarity 0.8 fails that with a
probability of 5e-5), and only texts with such a partner are sent on to be verified on their whole shingle sets.

With 16 bands of 3 samples a pair at similarity 0.8 shares no band with probability (1 - 0.8^3)^16 = 1e-5, at 0.9 with 5e-10.

Defined results: a null text is an empty one; texts without a word are never linked, each row its own class (class_id is
its doc_id); rows repeated in full are exact copies; class_id is the smallest doc_id of the class (null only if all are
null); an empty table gives an empty result; other columns are ignored.

Scale: texts are shuffled only for nodes with a candidate. Stages are written to the shared folder, so a lost executor
costs no earlier stage. Components come from alternating large-star and small-star rounds on written edges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm.common import Stages, free_names, normal_line

SHINGLE, THRESHOLD = 5, 0.8
N_BANDS, ROWS = 16, 3
DF_BITS, CHUNK_BITS, DAMP = 22, 16, 0.25
MIN_AGREE = 27  # of N_BANDS * ROWS samples
CELL = 256
BLOCK = 1 << 15  # shingles sampled at once, so that the arrays stay in a core's cache

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, in place."""
    z ^= z >> _U(30)
    z *= _K2
    z ^= z >> _U(27)
    z *= _K3
    z ^= z >> _U(31)
    return z


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of a normalised text, and their counts."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    words = text.split(" ")
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(w))):
        h *= _K1
        h += w[k:k + n]
    return np.unique(_mix(h), return_counts=True)


def weights(h: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return tf * (1.0 + idf[(h >> _U(64 - DF_BITS)).astype(np.int64)] * (DAMP / 255.0))


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum())
    return low / (float(a[1].sum()) + float(b[1].sum()) - low)


def _gamma_quantiles(bits: int = 12) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) e^-x, by bisection."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    lo, hi = np.zeros_like(p), np.full_like(p, 40.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(under, mid, lo), np.where(under, hi, mid)
    return lo.astype(np.float32)


GAMMA = _gamma_quantiles()


def samples(h: np.ndarray, w: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples of consecutive texts, whose shingles begin at ``starts``: (texts, samples) uint32.

    Per shingle and sample, r ~ Gamma(2,1), c ~ Gamma(2,1) and beta ~ U(0,1) come from a hash of both; t = floor(ln w / r +
    beta), a = c / (e^(r (t - beta)) e^r); the shingle with the smallest a, with its t, is the sample."""
    lnw = np.log(w).astype(np.float32)
    out = np.empty((len(starts), N_BANDS * ROWS), np.uint32)
    for s in range(N_BANDS * ROWS):
        z = _mix(h ^ _U((s + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = GAMMA[(z & _U(0xFFF)).astype(np.int32)]
        beta = ((z >> _U(12)) & _U(0xFFFF)).astype(np.float32) * np.float32(2.0**-16)
        v = ((z >> _U(28)) & _U(0x3FFFF)).astype(np.float32)
        v += np.float32(0.5)
        u = (z >> _U(46)).astype(np.float32)
        u += np.float32(0.5)
        v *= u
        v *= np.float32(2.0**-36)
        c = -np.log(v)
        t = np.floor(lnw / r + beta)
        a = c * np.exp(r * (beta - t - np.float32(1)))
        name = (z >> _U(20)).astype(np.uint32) ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        # positive floats sort as their bits; the name in the low half breaks ties alike in every text
        out[:, s] = np.minimum.reduceat((a.view(np.uint32).astype(np.uint64) << _U(32)) | name, starts) & _U(0xFFFFFFFF)
    return out


def band_keys(sampled: np.ndarray) -> np.ndarray:
    """(texts, bands) int64: a hash of each band's samples and number."""
    s = sampled.astype(np.uint64).reshape(len(sampled), N_BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, N_BANDS + 1, dtype=np.uint64) * _K1, s.shape[:2]).copy()
    for k in range(ROWS):
        key = _mix(key * _K3 + s[:, :, k])
    return key.view(np.int64)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the counters that are not zero, packed by chunk."""
    counts = np.zeros(1 << DF_BITS, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            h, _ = shingles(text)
            np.add.at(counts, (h >> _U(64 - DF_BITS)).astype(np.int64), 1)
    for chunk, part in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
        at = np.flatnonzero(part)
        if len(at):
            packed = zlib.compress(at.astype("<u2").tobytes() + part[at].astype("<i8").tobytes(), 1)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "packed": pa.array([packed], pa.binary())})


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(packed)
    n = len(raw) // 10
    return np.frombuffer(raw, "<u2", n), np.frombuffer(raw, "<i8", n, 2 * n)


def _sum_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the packed counters of the chunks of a partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at, n = _unpack(packed)
            sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))[at] += n
    for chunk, part in sums.items():
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "packed": pa.array([zlib.compress(part.astype("<i8").tobytes(), 1)], pa.binary())})


def idf_table(texts: DataFrame, n_docs: int) -> np.ndarray:
    """ln(N / df) / ln(N + 1) of each counter in 255 steps; 2^DF_BITS bytes, whatever the corpus."""
    schema = "chunk int, packed binary"
    chunks = 1 << (DF_BITS - CHUNK_BITS)
    parts = (texts.select("t").mapInArrow(_document_frequencies, schema)
             .repartition(chunks, "chunk").mapInArrow(_sum_chunk, schema))
    counts = np.zeros((chunks, 1 << CHUNK_BITS))
    for row in parts.collect():  # at most 2^(DF_BITS - CHUNK_BITS) rows of a chunk each
        counts[row["chunk"]] = np.frombuffer(zlib.decompress(row["packed"]), "<i8")
    df = np.clip(counts.ravel() - counts.mean(), 1, max(1, n_docs))
    return np.round(255 * np.clip(np.log(max(1, n_docs) / df) / np.log(n_docs + 1.0 if n_docs else 2.0), 0, 1)).astype(np.uint8)


def _signatures(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            keys = np.zeros((batch.num_rows, N_BANDS), np.int64)
            sampled = np.zeros((batch.num_rows, N_BANDS * ROWS), np.uint32)
            hs, ws, rows, size = [], [], [], 0

            def flush() -> None:
                if rows:
                    lens = np.fromiter(map(len, hs), np.int64, len(hs))
                    sampled[rows] = samples(np.concatenate(hs), np.concatenate(ws), np.cumsum(lens) - lens)
                    keys[rows] = band_keys(sampled[rows])

            for i, text in enumerate(batch.column(2).to_pylist()):
                if not text:
                    continue
                h, tf = shingles(text)
                hs.append(h)
                ws.append(weights(h, tf, table))
                rows.append(i)
                size += len(h)
                if size >= BLOCK:
                    flush()
                    hs, ws, rows, size = [], [], [], 0
            flush()
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, N_BANDS, dtype=np.int32), pa.array(keys.ravel()))
            packed = pa.array([x.tobytes() for x in sampled], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bands, packed], ["doc_id", "key", "bands", "samples"])
    return run


def _verified(idf, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = idf.value, {}

        def weighted(text: str) -> tuple:
            if (got := seen.get(text)) is None:
                if len(seen) >= 32:
                    seen.clear()
                h, tf = shingles(text)
                got = seen[text] = (h, weights(h, tf, table))
            return got

        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            ok = []
            for x, y in zip(ta, tb, strict=True):
                hub = weighted(y)
                h, tf = shingles(x)
                ok.append(similarity((h, weights(h, tf, table)), hub) >= threshold - 1e-9)
            ok = [i for i, v in enumerate(ok) if v]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in ok], pa.binary()), pa.array([b[i] for i in ok], pa.binary())], ["a", "b"])
    return run


def _verify(pairs: DataFrame, nodes: DataFrame, idf, threshold: float) -> DataFrame:
    """Of the pairs (a, b) of node keys, those at the threshold or above."""
    left, right = (nodes.select(F.col("key").alias(k), F.col("t").alias(t)) for k, t in (("a", "ta"), ("b", "tb")))
    # merge at every size: a plan that moves the texts must not hinge on how many pairs there happen to be
    joined = pairs.hint("merge").join(left, "a").hint("merge").join(right, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(_verified(idf, threshold), "a binary, b binary")


def _side(column, with_text: bool) -> tuple:
    """keys, parts, samples (rows, bands, rows of a band) and texts of one side of a block."""
    rows = column.values
    sampled = np.frombuffer(b"".join(rows.field("samples").to_pylist()), np.uint32).reshape(len(rows), N_BANDS, ROWS)
    return rows.field("key").to_pylist(), np.array(rows.field("part").to_pylist(), object), sampled, rows.field("t").to_pylist() if with_text else None


def _possible(band: int, x: np.ndarray, parts: np.ndarray, part: bytes, members: np.ndarray) -> np.ndarray:
    """Members of other parts that share this band with x as their first, and enough samples."""
    same = members == x
    bands = same.all(axis=2)
    return np.flatnonzero((bands.argmax(axis=1) == band) & bands[:, band] & (same.sum(axis=(1, 2)) >= MIN_AGREE) & (parts != part))


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, key) of the rows of a block that have a possible partner in it."""
    for batch in batches:
        for i in range(batch.num_rows):
            band = batch.column(1)[i].as_py()
            (qk, qp, qs, _), (mk, mp, ms, _) = (_side(batch.column(c)[i], False) for c in (2, 3))
            found = set()
            for key, part, x in zip(qk, qp, qs, strict=True):
                near = _possible(band, x, mp, part, ms)
                if len(near):
                    found.add(key)
                    found.update(mk[j] for j in near)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(found), pa.int64()), pa.array(sorted(found), pa.binary())], ["bucket", "key"])


def _linked(idf, threshold: float):
    """The links of a block: of each row on its left at most one to every part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            for i in range(batch.num_rows):
                band = batch.column(1)[i].as_py()
                (qk, qp, qs, qt), (mk, mp, ms, mt) = (_side(batch.column(c)[i], True) for c in (2, 3))
                vectors = [(h, weights(h, tf, table)) for h, tf in map(shingles, mt)]
                totals = np.array([w.sum() for _, w in vectors])
                links = []
                for key, part, x, text in zip(qk, qp, qs, qt, strict=True):
                    near = _possible(band, x, mp, part, ms)
                    if not len(near):
                        continue
                    h, tf = shingles(text)
                    w = weights(h, tf, table)
                    lens = np.array([len(vectors[j][0]) for j in near])
                    other, weight = (np.concatenate([vectors[j][k] for j in near]) for k in (0, 1))
                    at = np.minimum(np.searchsorted(h, other), len(h) - 1)
                    low = np.add.reduceat(np.where(h[at] == other, np.minimum(w[at], weight), 0.0), np.cumsum(lens) - lens)
                    alike = low / (w.sum() + totals[near] - low) >= threshold - 1e-9
                    links += {mp[j]: (key, mk[j]) for j in near[alike]}.values()
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])
    return run


def _blocks(rows: DataFrame, payload: list[str]) -> DataFrame:
    """bucket, band, and lists q (outside the largest part) and m (all) of the blocks of each bucket."""
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1))
    entry = F.struct("key", "part", *payload)
    q = rows.where(F.col("part") != F.col("main")).withColumn("qc", F.pmod(F.xxhash64("key"), F.col("cells"))).withColumn("mc", every)
    m = rows.withColumn("mc", F.pmod(F.xxhash64("key"), F.col("cells"))).withColumn("qc", every)
    place = ["bucket", "band", "qc", "mc"]
    left, right = (x.groupBy(*place).agg(F.collect_list(entry).alias(n)) for x, n in ((q, "q"), (m, "m")))
    return left.join(right, place).select("bucket", "band", "q", "m")


def components(stages: Stages, links: DataFrame, name: str) -> DataFrame:
    """(node, label) of all nodes with a link; the label is the smallest node of the component. Alternating large-star
    and small-star (Kiveris et al. 2014) until the written edges stay the same."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        if large:
            moved = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m").toDF("a", "b"))
        return moved.where(F.col("a") != F.col("b")).distinct()

    edges = stages.write(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), f"{name}-0")
    state, n = None, 0
    while True:
        n += 1
        after = stages.write(star(star(edges, True), False), f"{name}-{n}")
        stages.drop(edges)
        edges = after
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.toDF("node", "label")
        state = now


def _empty() -> Column:
    """The key of texts without a word."""
    return F.unhex(F.md5(F.lit("")))


def labelled(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, key (hash of the normalised text), label (smallest key of the class; the own key for texts without a
    word, which are no class), in one row per row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    stages = Stages(spark, "near-duplicates")
    t = F.coalesce(normal_line(F.col("text")), F.lit(""))
    texts = docs.select("doc_id", t.alias("t")).select("doc_id", F.unhex(F.md5("t")).alias("key"), "t")
    idf = spark.sparkContext.broadcast(idf_table(texts, docs.count()))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sig = stages.write(texts.mapInArrow(_signatures(idf), f"doc_id {id_type}, key binary, bands array<bigint>, samples binary"), "signatures")
    nodes = sig.where(F.col("key") != _empty()).groupBy("key").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    rows = nodes.select("key", F.posexplode("bands").alias("band", "bucket"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n >= 2")
    members = stages.write(rows.join(full, "bucket"), "members")
    reach = members.groupBy("key").agg(F.sum("n").alias("reach"))
    hubs = members.join(reach, "key").groupBy("bucket").agg(F.max(F.struct("reach", "key"))["key"].alias("hub"))
    hubs = stages.write(members.select("bucket", "band", "key").join(hubs, "bucket"), "hubs")
    pairs = hubs.where(F.col("key") != F.col("hub")).select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()

    wanted = members.select(F.col("key").alias("k")).distinct()
    node_texts = stages.write(texts.join(wanted.hint("merge"), F.col("key") == F.col("k"), "left_semi").groupBy("key").agg(F.first("t").alias("t")), "texts")
    links = stages.write(_verify(pairs, node_texts, idf, threshold), "links")
    label = components(stages, links, "parts")

    # buckets still in several parts: all outside the largest part against the members of the other parts
    parted = hubs.join(label, F.col("key") == F.col("node"), "left").select("bucket", "band", "key", F.coalesce("label", "key").alias("part"))
    sizes = parted.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    in_parts = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count("*").alias("parts"),
                                           F.ceil(F.sum("n") / CELL).alias("cells")).where("parts >= 2").drop("parts")
    open_rows = stages.write(parted.join(in_parts, "bucket").join(nodes.select("key", "samples"), "key"), "open")
    promising = _blocks(open_rows, ["samples"]).mapInArrow(_promising, "bucket bigint, key binary").distinct()
    promising = stages.write(promising, "promising")
    full_rows = open_rows.join(promising, ["bucket", "key"]).hint("merge").join(node_texts, "key")
    more = stages.write(_blocks(full_rows, ["samples", "t"]).mapInArrow(_linked(idf, threshold), "a binary, b binary"), "more")
    label = components(stages, links.union(more), "classes")

    return sig.select("doc_id", "key").join(label, F.col("key") == F.col("node"), "left").select("doc_id", "key", F.coalesce("label", "key").alias("label"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, key (hash of the normalised text), class_id, in one row per row of ``docs``."""
    classed = labelled(docs, threshold)
    least = classed.where(F.col("key") != _empty()).groupBy(F.col("label").alias("g")).agg(F.min("doc_id").alias("class_id"))
    return classed.join(least, F.col("label") == F.col("g"), "left").select(
        "doc_id", "key", F.when(F.col("key") == _empty(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of each class the row with its smallest doc_id, null last; where rows share that doc_id, the first in (key) order. Texts
    without a word are no copies of each other and stay; of rows repeated in full one stays."""
    of_id, of_key, own = free_names(docs, "_id", "_key", "_own")
    classed = labelled(docs.select("doc_id", "text"), threshold)
    none = F.col("key") == _empty()
    # a doc_id names no class: it may be null, or be shared by unrelated texts
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    chosen = classed.where(~none).groupBy("label").agg(least.alias("row")).select(F.col("row.doc_id").alias(of_id), F.col("row.key").alias(of_key))
    chosen = chosen.unionByName(classed.where(none).select(F.col("doc_id").alias(of_id), F.col("key").alias(of_key)).distinct())
    key = F.unhex(F.md5(F.coalesce(normal_line(F.col("text")), F.lit(""))))
    kept = docs.withColumn(own, key).join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_key)), "left_semi")
    return kept.dropDuplicates(["doc_id", own]).drop(own)
