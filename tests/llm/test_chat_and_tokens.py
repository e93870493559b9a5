"""Long conversations, and which pre-tokens the broadcast table holds."""

import math
import random
import time
from collections import Counter

import public_tokenizers as P
import xxhash
from pyspark.sql import functions as F

from tabmill.llm import chat_parts, token_counts

WORDS = P.path("word_bpe_49k.json")


def _digest(spark, n):
    rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
                                 F.concat(F.lit("é <| \\ "), F.col("id").cast("string")).alias("text"))
    done = chat_parts.format_conversations(rows.select("conv_id", "turn", "role", chat_parts.text_part(F.col("text")).alias("parts")))
    start = time.time()
    row = done.select("formatted", "loss_spans", chat_parts.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                      F.size(chat_parts.read_turns(F.col("formatted"))).alias("n")).first()
    return row, time.time() - start


def test_long_conversation_spans_and_time(spark):
    row, _ = _digest(spark, 2000)
    texts = [f"é <| \\ {i}" for i in range(1, 2000, 2)]
    assert row["n"] == 2000 and row["loss"] == "".join(texts)
    for s, text in zip(row["loss_spans"], texts, strict=True):
        assert row["formatted"][s["start"]:s["start"] + s["length"]] == text.replace("\\", "\\\\").replace("<|", "<\\|")
    _, one = _digest(spark, 8000)
    row, four = _digest(spark, 32000)
    assert row["n"] == 32000 and four < 8 * max(one, 1.0)  # with the square of the turns it would be 16


def test_summary_loses_no_more_than_its_bound():
    rng = random.Random(3)
    stream = [f"w{int(rng.paretovariate(0.8))}" for _ in range(60_000)]
    summary = token_counts.Summary(200)
    for i in range(0, len(stream), 100):
        summary.add(stream[i:i + 100])
    exact = Counter(stream)
    assert summary.total == len(stream) and len(summary.counts) <= 400
    for w, n in exact.items():
        assert n - len(stream) / 200 <= summary.counts[w] <= n


def test_table_holds_the_frequent_pre_tokens_of_all_documents(spark):
    rng = random.Random(4)
    # each part of the table has words of its own; the last rows hold the most frequent ones
    docs = [(i, " ".join(f"p{i // 50}x{int(rng.paretovariate(1.2))}" for _ in range(80)) + (" late" * 30 if i >= 350 else "")) for i in range(400)]
    exact = Counter(w for _, t in docs for w in t.split())
    room = token_counts.LengthTable(8).room
    table = token_counts.frequent_lengths(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), WORDS, bits=8)
    held = {w for w in exact if table.get(token_counts.np.array([xxhash.xxh3_64_intdigest(w)], token_counts.np.uint64))[0]}
    least = min(math.floor(math.log2(exact[w]) * 8) for w in held)
    assert "late" in held and held == {w for w, n in exact.items() if math.floor(math.log2(n) * 8) >= least}
    assert len(held) <= room < sum(n >= 2 ** ((least - 1) / 8) for n in exact.values())  # the next class would not fit
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in token_counts.token_counts(empty, WORDS).orderBy("doc_id").collect()] == [(1, 0, 0, False), (2, 0, 0, False)]
