"""Line dedup by a suffix array over line IDs (DataFrame functions only).

A document is the sequence of IDs of its lines that hold a word (ID: hash of the normalised line; lines without
a word are skipped). Repeated runs come from prefix doubling: the rank of the 2^(k+1) lines from a position is the
rank of the pair (rank of 2^k lines there, rank of the 2^k lines that follow), ranks being dealt in sorted order of
the pairs by a range partition. A block that occurs once ends its suffix's share in the repeats, so it leaves; lines
that occur once leave before the first round, and with them most of the corpus.

Suffixes with a common prefix of m lines, 2^k <= m <= 2^(k+1), are the interval of the suffix array with equal ranks of
the two blocks of 2^k lines that cover the m lines: the longest-common-prefix interval for m. A run of lines is a
repeat when it holds ``min_words`` words or more and its interval has an earlier member in corpus order (doc_id, then
text hash, then line). All lines of repeats are deleted, so the first copy stays. Every repeat is the union of the
shortest runs of ``min_words`` words that begin, or end, at each of its lines, so only the intervals of those are looked
up. Such runs have at most ``min_words`` lines, hence floor(log2(min_words)) rounds give the exact result for
runs of any length.

Defined results: a null text is an empty one; rows of the same doc_id and text are one document here (no copies of each
other: their rows get the same lines deleted); a run may overlap its earlier copy (of one line said a thousand times the
first stays); no run spans two documents; an empty table gives an empty result; extra columns are kept by
``dedup_lines`` and may have any name.

Scale: all shuffles carry narrow keys (document, line number, ranks) of repeated lines only; counts are pre-aggregated
map-side, so a line with a third of all rows costs a row per task; windows hold one document; joins on ranks can be
split by AQE. The texts meet the deleted lines in one join by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.common import Stages, free_names, n_words, normal_line, without_lines

MIN_WORDS = 50

DOC = ["doc_id", "text_hash"]


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line (0-based, of all lines), pos (0-based, of lines with a word), id, words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("raw"))
    d = d.select(*DOC, F.filter(
        F.transform("raw", lambda x, i: F.struct(normal_line(x).alias("s"), i.alias("line"))),
        lambda x: x["s"] != "").alias("lines"))
    d = d.select(*DOC, F.posexplode(F.transform("lines", lambda x: F.struct(
        x["line"].alias("line"), F.xxhash64(x["s"]).alias("id"), n_words(x["s"]).alias("words")))).alias("pos", "l"))
    return d.select(*DOC, "pos", "l.line", "l.id", "l.words")


def _ordered_ids(pairs: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Ids in the sort order of ``cols``: the range partition and the row within it make the id, so no task sees all
    rows. The caller writes the result, which fixes them."""
    return (pairs.repartitionByRange(*cols).sortWithinPartitions(*cols)
            .withColumn(name, F.monotonically_increasing_id()))


def repeated_positions(stages: Stages, lines: DataFrame, min_words: int) -> DataFrame:
    """Lines that occur twice or more in the corpus, in islands (consecutive ones of a document) of ``min_words``
    words or more; with island and the words before the line in it."""
    repeated = lines.groupBy("id").agg(F.count("*").alias("n")).where("n >= 2").select("id")
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    p = lines.join(repeated, "id").dropDuplicates([*DOC, "pos"])
    p = p.withColumn("island", F.col("pos") - F.row_number().over(by_doc))
    in_island = Window.partitionBy(*DOC, "island")
    p = p.withColumn("total", F.sum("words").over(in_island)).where(F.col("total") >= min_words)
    before = F.sum("words").over(in_island.orderBy("pos")) - F.col("words")
    p = p.withColumn("before", before).withColumn("end", F.max("pos").over(in_island) + 1)
    return stages.write(p.select(*DOC, "pos", "line", "id", "words", "island", "before", "total", "end"), "repeated")


def doubled(stages: Stages, level: DataFrame, k: int) -> DataFrame:
    """From the ranks of blocks of 2^k lines (document, pos, r) those of 2^(k+1) lines, where they repeat."""
    ahead = Window.partitionBy(*DOC).orderBy("pos").rangeBetween(2**k, 2**k)
    both = level.withColumn("next", F.max("r").over(ahead)).where("next is not null")
    pairs = both.groupBy("r", "next").agg(F.count("*").alias("n")).where("n >= 2").drop("n")
    ranks = stages.write(_ordered_ids(pairs, ["r", "next"], "rank"), f"ranks{k + 1}")
    return stages.write(both.join(ranks, ["r", "next"]).select(*DOC, "pos", F.col("rank").alias("r")), f"level{k + 1}")


def shortest_runs(p: DataFrame, min_words: int) -> DataFrame:
    """(document, pos, m): the shortest runs of ``min_words`` words or more from each line on, and up to each line."""
    island = Window.partitionBy(*DOC, "island")
    # from pos on: up to the first line that begins min_words after it
    to = F.min("pos").over(island.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing))
    forward = p.withColumn("to", F.coalesce(to, F.col("end"))).where(F.col("total") - F.col("before") >= min_words)
    # up to and with pos: from the line after the last that ends min_words before it
    q = p.withColumn("upto", F.col("before") + F.col("words"))
    frm = F.max("pos").over(island.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)) + 1
    start = F.min("pos").over(island)
    backward = q.withColumn("from", F.coalesce(frm, start)).where(F.col("upto") >= min_words)
    return (forward.select(*DOC, "pos", (F.col("to") - F.col("pos")).alias("m"))
            .unionByName(backward.select(*DOC, F.col("from").alias("pos"), (F.col("pos") + 1 - F.col("from")).alias("m")))
            .distinct())


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, gone): the numbers of the lines to delete, for documents that have any."""
    stages = Stages(docs.sparkSession, "line-runs")
    lines = stages.write(line_table(docs), "lines")
    p = repeated_positions(stages, lines, min_words)
    levels = [p.select(*DOC, "pos", F.col("id").alias("r"))]
    for k in range(min_words.bit_length() - 1):
        levels.append(doubled(stages, levels[-1], k))
    ranks = reduce(DataFrame.unionByName, [x.withColumn("k", F.lit(k)) for k, x in enumerate(levels)])
    runs = shortest_runs(p, min_words).withColumn("k", F.floor(F.log2("m")).cast("int"))
    runs = runs.withColumn("tail", F.col("pos") + F.col("m") - F.pow(F.lit(2), F.col("k")).cast("int"))
    # the two blocks of 2^k lines that cover the run; a run with a block that occurs once occurs once
    for at, name in (("pos", "ra"), ("tail", "rb")):
        r = ranks.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("at"), F.col("k").alias("l"), F.col("r").alias(name))
        runs = runs.join(r, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
                         & (F.col(at) == F.col("at")) & (F.col("k") == F.col("l"))).drop("d", "h", "at", "l")
    runs = stages.write(runs, "runs")
    place = F.struct(*DOC, "pos")
    intervals = runs.groupBy("k", "m", "ra", "rb").agg(F.min(place).alias("first"), F.count("*").alias("size")).where("size >= 2")
    copies = runs.join(intervals.drop("size"), ["k", "m", "ra", "rb"]).where(place > F.col("first"))
    gone = copies.select(*DOC, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("m") - 1)).alias("pos")).distinct()
    at = p.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("at"), "line")
    gone = (gone.join(at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")) & (F.col("pos") == F.col("at")))
            .groupBy(*DOC).agg(F.sort_array(F.collect_list("line")).alias("gone")))
    return stages.write(gone, "gone")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its later copies of repeated runs deleted from ``text``, and last ``_gone``, the numbers of the
    deleted lines (null: none); with more underscores where ``docs`` has a column of that name."""
    k, h, mark = free_names(docs, "_k", "_h", "_gone")
    # merge at every size: whether the list of deletions happens to be small enough to broadcast must not decide the plan
    gone = later_copies(docs.select("doc_id", "text"), min_words).hint("merge").select(
        F.col("doc_id").alias(k), F.col("text_hash").alias(h), F.col("gone").alias(mark))
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(k)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(h)), "left")
    return without_lines(out, mark).select(*[F.col(f"`{c}`") for c in docs.columns], mark)
