"""Approximate nearest neighbours by largest inner product: a hash-prefix forest.

Each of ``TREES`` trees gives a vector a long hash string: ``DIGITS`` cross-polytope digits (a random rotation's largest coordinate and
its sign), as bits. Vectors get one more coordinate that brings all to the same length, so the largest inner product is the
smallest angle. A tree is the array of its strings in sorted order, cut into blocks by prefixes: a block is a prefix that at most
``BLOCK`` rows share, refined until that holds; rows of one whole string go on in numbered sub-blocks.

A query descends in every tree to its longest matching prefix by binary search, then ascends in all trees at once, a bit at a time: the level
at which the trees together hold the wanted number of candidates is found from the counts per level, in the block and, above it, of all blocks under the
shorter prefix; then every tree scores all rows that share the prefix of that level, in as many blocks as hold them, and each block keeps its best; the best
of all are the result, scored in double precision on the original vectors. Wanted: 2.75 N^0.8 candidates, at least ``PER_TREE`` per tree. A query that
ascends to the empty prefix meets all rows, in one tree. A query with fewer results than asked is compared with all rows, in blocks.

Equal vectors are one entry with its smallest ids (one more than the results asked for; ties go to smaller ids, so no other can be in a result).

Defined results: vectors that are null, zero, of another length than most, or hold a null or non-finite component take no part, nor do rows with
a null vec_id; rows of one vec_id are one vector, the smallest in array order; a table without vectors gives an empty result; other columns are ignored.

Scale: all groups (blocks) are bounded by ``BLOCK``, the rows a query meets are not; hot vectors are cut to their smallest ids before the shuffle; counts are pre-aggregated. The index
holds each vector once per tree, so that a block scores its own rows and no candidate pair is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.common import Stages

TREES, DIGITS, BLOCK, PER_TREE, STEP, SEED = 40, 6, 4096, 1000, 3, 11
AXES = 64  # of a cross-polytope digit


def bits_of(dim: int) -> int:
    """Bits of a hash string."""
    return DIGITS * (2 * min(dim + 1, AXES) - 1).bit_length()


@lru_cache(maxsize=512)
def _rotation(dim: int, tree: int, digit: int) -> np.ndarray:
    """(dim + 1, axes) with orthonormal columns, the same in every worker."""
    q, _ = np.linalg.qr(np.random.default_rng((SEED, tree, digit)).standard_normal((dim + 1, min(dim + 1, AXES))))
    return np.ascontiguousarray(q, dtype=np.float32)


def hash_strings(x: np.ndarray) -> np.ndarray:
    """(rows, trees) int64 of vectors brought to one length (rows, dim + 1)."""
    dim = x.shape[1] - 1
    width = (2 * min(dim + 1, AXES) - 1).bit_length()
    out = np.zeros((len(x), TREES), np.int64)
    x = x.astype(np.float32)
    rows = np.arange(len(x))
    for tree in range(TREES):
        for digit in range(DIGITS):
            y = x @ _rotation(dim, tree, digit)
            axis = np.abs(y).argmax(axis=1)
            out[:, tree] = (out[:, tree] << width) | (axis * 2 + (y[rows, axis] > 0))
    return out


def same_length(v: np.ndarray, longest: float) -> np.ndarray:
    """Rows of ``v`` over the longest length, with the coordinate that is missing to 1."""
    v = v.astype(np.float64) / longest
    return np.hstack([v, np.sqrt(np.clip(1 - (v * v).sum(axis=1, keepdims=True), 0, None))])


def _coded(longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                codes = hash_strings(same_length(v, longest))
                lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, TREES, dtype=np.int32), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["rep", "vec", "codes"])
    return run


def _prefix(code: Column, depth: Column | int, bits: int) -> Column:
    return F.call_function("shiftright", code, (F.lit(bits) - depth).cast("int"))


def _blocks(stages: Stages, codes: DataFrame, n: int, bits: int) -> DataFrame:
    """(tree, depth, prefix, n, subs): prefixes that at most BLOCK rows share, disjoint and covering all rows."""
    depth = min(bits, max(0, math.ceil(math.log2(max(1, n) / BLOCK))))
    found, rest = [], codes
    while True:
        counts = stages.write(rest.groupBy("tree", _prefix(F.col("code"), depth, bits).alias("prefix")).agg(F.count("*").alias("n"))
                              .withColumn("depth", F.lit(depth)), f"blocks{depth}")
        if depth == bits:
            found.append(counts)
            break
        found.append(counts.where(F.col("n") <= BLOCK))
        over = counts.where(F.col("n") > BLOCK)
        if over.isEmpty():
            break
        rest = rest.withColumn("prefix", _prefix(F.col("code"), depth, bits)).join(over.select("tree", "prefix"), ["tree", "prefix"], "left_semi").drop("prefix")
        depth = min(bits, depth + STEP)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return stages.write(out.select("tree", "depth", "prefix", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("subs")), "blocks")


def _under(blocks: DataFrame) -> DataFrame:
    """``blocks`` once for each of their prefixes, own included: (tree, at, above) name a prefix of ``at`` bits."""
    rows = blocks.withColumn("at", F.explode(F.sequence(F.lit(0), "depth")))
    return rows.withColumn("above", F.call_function("shiftright", F.col("prefix"), F.col("depth") - F.col("at")))


def _counts_above(blocks: DataFrame) -> DataFrame:
    """(tree, depth, prefix, up): per block the rows of its prefixes of 0, 1, ... and all its bits."""
    under = _under(blocks)
    totals = under.groupBy("tree", "at", "above").agg(F.sum("n").alias("total"))
    up = under.join(totals, ["tree", "at", "above"]).groupBy("tree", "depth", "prefix").agg(F.array_sort(F.collect_list(F.struct("at", "total"))).alias("up"))
    return up.withColumn("up", F.col("up.total"))


def _placed(codes: DataFrame, blocks: DataFrame, depths: list[int], bits: int, key: str, everywhere: bool) -> DataFrame:
    """``codes`` (tree, code, key, ...) with its block; in one of its sub-blocks or in all."""
    rows = codes.withColumn("depth", F.explode(F.array(*map(F.lit, depths)))).withColumn("prefix", _prefix(F.col("code"), F.col("depth"), bits))
    rows = rows.join(blocks.drop("n"), ["tree", "depth", "prefix"])
    sub = F.explode(F.sequence(F.lit(0), F.col("subs") - 1)) if everywhere else F.pmod(F.xxhash64(key), F.col("subs")).cast("int")
    return rows.withColumn("sub", sub).drop("subs")


def _fields(column, *names) -> list[np.ndarray]:
    """Numpy arrays of the fields of one row's list of structs."""
    values = column.values
    return [np.asarray(values.field(n)) if not pa.types.is_list(values.type.field(n).type)
            else values.field(n).flatten().to_numpy().reshape(len(values), -1) for n in names]


def _range(codes: np.ndarray, q: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    low = (q >> shift) << shift
    return np.searchsorted(codes, low), np.searchsorted(codes, low + (1 << shift))


def _level_counts(bits: int):
    """Per query and block: (query, level, rows that share this level and not the next)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                depth = batch.column(0)[i].as_py()
                (codes,) = _fields(batch.column(1)[i], "code")
                reps, q = _fields(batch.column(2)[i], "rep", "code")
                held = np.zeros(len(q), np.int64)
                for level in range(bits, depth - 1, -1):
                    lo, hi = _range(codes, q, bits - level)
                    more = np.flatnonzero(hi - lo > held)
                    if len(more):
                        n = (hi - lo)[more]
                        yield pa.RecordBatch.from_arrays([pa.array(reps[more]), pa.array(np.full(len(more), level, np.int32)),
                                                          pa.array(n - held[more])], ["rep", "level", "n"])
                        held[more] = n
    return run


def exact_scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for a pair wherever it is scored."""
    return (v.astype(np.float64) * q.astype(np.float64)).sum(axis=1)


def _best(bits: int, keep: int):
    """Per query and block: the rows of the largest inner product in the level's range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                depth = batch.column(0)[i].as_py()
                codes, ids, vecs = _fields(batch.column(1)[i], "code", "rep", "vec")
                reps, q, levels, qvecs = _fields(batch.column(2)[i], "rep", "code", "level", "vec")
                out = ([], [], [])
                for rep, code, level, vec in zip(reps, q, levels, qvecs, strict=True):
                    if level <= depth:
                        lo, hi = 0, len(codes)
                    else:
                        (lo,), (hi,) = _range(codes, np.array([code]), int(bits - level))
                    if lo >= hi:
                        continue
                    near = np.arange(lo, hi)
                    if hi - lo > 4 * keep:  # rough scores only narrow down, with room for their rounding
                        near = lo + np.argpartition(vecs[lo:hi] @ vec, hi - lo - 2 * keep)[-2 * keep:]
                    scores = exact_scores(vecs[near], vec)
                    order = np.lexsort((ids[near], -scores))[:keep]
                    out[0].append(np.full(len(order), rep))
                    out[1].append(ids[near[order]])
                    out[2].append(scores[order])
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query", "rep", "score"])
    return run


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, vec of the rows that take part, one per vec_id."""
    v = table.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(~bad & F.exists("vec", lambda x: x != 0))
    v = v.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    dim = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return v.where(F.size("vec") == (dim["d"] if dim else 0))


def neighbours(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of ``table`` for which ``is_query`` (over vec_id) holds."""
    stages = Stages(table.sparkSession, "forest")
    keep = k + 1
    key = F.md5(F.concat_ws(",", F.transform("vec", lambda x: x.cast("string"))))
    vectors = stages.write(valid_vectors(table, id_col, vec_col).withColumn("key", key), "vectors")
    shape = vectors.agg(F.max(F.size("vec")).alias("dim"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("len")).first()
    if shape["dim"] is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    bits = bits_of(shape["dim"])
    low = vectors.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("nth") <= keep)
    entries = low.groupBy("key").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
    entries = stages.write(entries, "entries")
    n = entries.count()
    asked = stages.write(vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "key").join(entries.select("key", "rep"), "key").select("query_id", "rep"), "asked")

    vec_type = entries.schema["vec"].dataType.simpleString()
    coded = stages.write(entries.select("rep", "vec").repartition("rep").mapInArrow(_coded(shape["len"]), f"rep bigint, vec {vec_type}, codes array<bigint>"), "coded")
    blocks = _blocks(stages, coded.select(F.posexplode("codes").alias("tree", "code")), n, bits)
    depths = sorted(r["depth"] for r in blocks.select("depth").distinct().collect())
    spread = coded.select("rep", "vec", F.posexplode("codes").alias("tree", "code"))
    place = ["tree", "depth", "prefix", "sub"]
    # a few blocks per task: they go through tasks as whole rows
    tasks = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(blocks.agg(F.sum("subs")).first()[0] / 8))
    index = stages.write(_placed(spread, blocks, depths, bits, "rep", False).repartition(tasks, *place).groupBy(*place).agg(
        F.array_sort(F.collect_list(F.struct("code", "rep", "vec"))).alias("rows")), "index")

    distinct = asked.select("rep").distinct()
    mine = spread.join(distinct, "rep", "left_semi")
    probes = stages.write(_placed(mine.select("rep", "tree", "code"), blocks, depths, bits, "rep", True), "probes")
    codes_only = index.select(*place, F.transform("rows", lambda x: F.struct(x["code"].alias("code"))).alias("rows"))
    at_block = probes.repartition(tasks, *place).groupBy(*place).agg(F.collect_list(F.struct("rep", "code")).alias("q"))
    counts = codes_only.repartition(tasks, *place).hint("merge").join(at_block, place).select("depth", "rows", "q").mapInArrow(_level_counts(bits), "rep bigint, level int, n bigint")
    own = probes.where("sub = 0").select("rep", "tree", "code", "depth", "prefix")
    up = F.col("up")
    above = own.where("depth > 0").join(_counts_above(blocks), ["tree", "depth", "prefix"]).select("rep", F.posexplode(
        F.transform(F.slice(up, 1, F.size(up) - 1), lambda total, i: total - F.get(up, i + 1))).alias("level", "n"))
    wanted = max(TREES * PER_TREE, 2.75 * n**0.8)
    per_level = counts.unionByName(above).groupBy("rep", "level").agg(F.sum("n").alias("n"))
    reached = F.sum("n").over(Window.partitionBy("rep").orderBy(F.desc("level")))
    levels = per_level.withColumn("reached", reached).where(F.col("reached") >= wanted).groupBy("rep").agg(F.max("level").alias("level"))

    # the blocks under the prefix of the level; the empty prefix holds all rows in any one tree
    probes = own.drop("prefix").join(stages.write(levels, "levels"), "rep", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    probes = probes.where("level > 0 or tree = 0").withColumn("at", F.least("level", "depth")).withColumn("above", _prefix(F.col("code"), F.col("at"), bits))
    probes = probes.drop("depth").join(_under(blocks), ["tree", "at", "above"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    probes = probes.select("rep", "code", "level", *place).join(entries.select("rep", F.col("vec")), "rep")
    at_block = probes.repartition(tasks, *place).groupBy(*place).agg(F.collect_list(F.struct("rep", "code", "level", "vec")).alias("q"))
    found = index.repartition(tasks, *place).hint("merge").join(at_block, place).select("depth", "rows", "q").mapInArrow(_best(bits, keep), "query bigint, rep bigint, score double")
    best = stages.write(_top(found.distinct(), keep), "best")

    # queries with too few results meet all rows, a block at a time
    enough = min(keep, n)
    short = distinct.join(best.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= enough), F.col("rep") == F.col("query"), "left_anti")
    if not short.isEmpty():
        vecs = short.join(entries, "rep").select("rep", "vec").withColumn("g", F.pmod("rep", F.lit(64)))
        groups = vecs.groupBy("g").agg(F.collect_list(F.struct("rep", F.lit(0).cast("bigint").alias("code"), F.lit(0).alias("level"), "vec")).alias("q")).select("q")
        every = index.where("tree = 0").select("depth", "rows").join(groups, F.lit(True)).mapInArrow(_best(bits, keep), "query bigint, rep bigint, score double")
        best = stages.write(_top(best.union(every).distinct(), keep), "more")

    members = entries.select("rep", F.explode("ids").alias("vec_id"))
    per_entry = best.join(members, "rep").select("query", "vec_id", "score")
    per_entry = stages.write(_top(per_entry.select("query", F.col("vec_id").alias("rep"), "score"), keep), "members")
    out = asked.join(per_entry, F.col("query") == asked["rep"]).where(F.col("query_id") != per_entry["rep"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), per_entry["rep"]))
    return out.select("query_id", rank.alias("rank"), per_entry["rep"].alias("vec_id"), "score").where(F.col("rank") <= k)


def _top(pairs: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` (query, rep, score) of each query; Spark cuts the ranks before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "rep"))
    return pairs.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")
