"""Quality rules by cross-document line frequency (DataFrame functions only).

Lines are normalised (lower case, white space collapsed, digits as 0) and hashed; per host the
distinct documents that hold a line are counted, where two rows with the same text are one document
(exact copies are another operator's matter). A line held by more documents of its host than the
limit, ``max(min_docs, share * documents of the host)``, is removed. A document is depleted, and
rejected, when fewer than ``min_left`` words or less than ``min_left_share`` of its words remain.

Defined results: a null text is an empty one (no words, so the base rules reject it); a null host is
a host of its own; rows repeated in full are judged alike and all returned; an empty table gives an
empty result; columns other than the named ones are ignored.

Scale: the text is read once, into a table with one row per document that holds its counts and the
hashes of its lines; all shuffles carry (host, hash) keys, pre-aggregated map-side, so a host with a
third of all rows spreads over its lines. The table of frequent lines is joined without a hint, and
Spark broadcasts it only when its written size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.llm.common import WS, WS_CHARS, Stages, free_names, n_words, normal_line, without_lines, words

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
MIN_DOCS, SHARE, MIN_LEFT, MIN_LEFT_SHARE = 100, 0.05, 10, 0.3
SYMBOLS = "#*$%&|<>"


def line_key(line: Column) -> Column:
    return F.regexp_replace(normal_line(line), "[0-9]", "0")


def profile(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: the base counts, and ``lines``: (key hashes, words) of each line with a word, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.coalesce(F.col(host), F.lit("")).alias("host"), text.alias("text"))
    d = d.select(
        "doc_id", "host", F.xxhash64("text").alias("text_hash"),
        words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{WS}]")).alias("raw"),
        F.length(F.translate("text", WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    d = d.select(
        "doc_id", "host", "text_hash", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)),
            lambda i: F.xxhash64(*[F.element_at("w", i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("win"),
        F.transform("raw", line_key).alias("keys"))
    sorted_windows = F.array_sort(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("sw", F.when(F.size(F.array_distinct("win")) < F.size("win"), sorted_windows))
    at = lambda i: F.get("sw", i)["h"]
    # equal windows lie side by side; their words are the steps between their starts, each WINDOW at most
    twice = F.array_sort(F.transform(
        F.filter("sw", lambda x, i: (F.coalesce(at(i - 1) == x["h"], F.lit(False)))
                 | F.coalesce(at(i + 1) == x["h"], F.lit(False))), lambda x: x["i"]))
    d = d.withColumn("rep", twice)
    step = F.transform("rep", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("rep", i + 1) - p, F.lit(WINDOW))))
    return d.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.aggregate(step, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform("keys", lambda k: F.struct(F.xxhash64(k).alias("h"), F.hash(k).alias("g"), n_words(k).alias("w"))).alias("lines"))


def line_frequency(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
                   min_left: int = MIN_LEFT, min_left_share: float = MIN_LEFT_SHARE) -> tuple[DataFrame, DataFrame]:
    """(verdicts, frequent): a verdict row per row of ``docs`` (doc_id, text_hash, the base counts, left_words,
    base_failed, kept, gone: numbers of the removed lines among those with a word), and the removed lines per host (host, h, g)."""
    stages = Stages(docs.sparkSession, "line-frequency")
    p = stages.write(profile(docs, host), "profile")
    lines = p.select("doc_id", "host", "text_hash", F.posexplode("lines").alias("pos", "l")).select(
        "doc_id", "host", "text_hash", "pos", "l.h", "l.g", "l.w")
    per_host = p.groupBy("host").agg(F.count_distinct("text_hash").alias("docs"))
    held = lines.groupBy("host", "h", "g").agg(F.count_distinct("text_hash").alias("n")).where(F.col("n") > min_docs)
    frequent = stages.write(
        held.join(per_host, "host").where(F.col("n") > F.col("docs") * share).select("host", "h", "g"), "frequent")
    # the position keeps the equal lines of a row apart, while rows repeated in full meet and count once
    lost = (lines.join(frequent, ["host", "h", "g"])
            .groupBy("doc_id", "host", "text_hash", "pos").agg(F.first("w").alias("w"))
            .groupBy(F.col("doc_id").alias("k"), F.col("host").alias("kh"), F.col("text_hash").alias("kt"))
            .agg(F.sum("w").alias("lost"), F.collect_list("pos").alias("gone")))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = p.drop("lines").join(lost, p.doc_id.eqNullSafe(F.col("k")) & (p.host == F.col("kh"))
                               & (p.text_hash == F.col("kt")), "left")
    out = out.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        left.cast("long").alias("left_words"), base_failed.alias("base_failed"),
        (~base_failed & (left >= min_left) & (left >= min_left_share * F.col("n_words"))).alias("kept"), "gone")
    return out, frequent


def kept_documents(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that are not rejected, without the lines above their host's limit (``text`` and ``n_chars``). The
    texts are shuffled once, to meet their verdicts."""
    gone, k, kh, kt, own_host, own_hash, lines, worded = free_names(
        docs, "__gone", "__k", "__kh", "__kt", "__host", "__hash", "__all", "__worded")
    verdicts, _ = line_frequency(docs, host, **limits)
    v = verdicts.where("kept").groupBy("doc_id", "host", "text_hash").agg(F.first("gone").alias(gone)).select(
        F.col("doc_id").alias(k), F.col("host").alias(kh), F.col("text_hash").alias(kt), gone)
    rows = docs.withColumns({own_host: F.coalesce(F.col(host), F.lit("")), own_hash: F.xxhash64(F.coalesce("text", F.lit("")))})
    rows = rows.join(v.hint("merge"), rows["doc_id"].eqNullSafe(F.col(k)) & (F.col(own_host) == F.col(kh)) & (F.col(own_hash) == F.col(kt)))
    # numbers among the lines with a word to numbers among all lines
    rows = rows.withColumn(lines, F.when(F.col(gone).isNotNull(), F.split("text", "\n")))
    rows = rows.withColumn(worded, F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(f"[^{WS}]")))
    rows = rows.withColumn(gone, F.transform(gone, lambda p: F.get(worded, p)))
    out = without_lines(rows, gone)
    if "n_chars" in docs.columns:
        cut = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(gone).isNotNull(), cut).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
