"""Line frequency and line runs against brute force, and their defined results on odd input."""

import random

from pyspark.sql import functions as F

from tabmill.llm import line_frequency as lf
from tabmill.llm import line_runs

COLS = "doc_id long, text string, lang string, source string, n_chars long, k string, h string, gone string"


def docs_of(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, "s"), 0 if t is None else len(t), "x", "y", "z") for i, t in texts]
    return spark.createDataFrame(rows, COLS)


def brute_gone(texts, min_words):
    """Deleted lines by the definition: all runs with an earlier copy, whatever their length."""
    seqs = []
    for doc, text in sorted(texts, key=lambda x: x[0]):
        lines = [(i, " ".join(s.split()).lower()) for i, s in enumerate((text or "").split("\n"))]
        seqs.append((doc, [x for x in lines if x[1]]))
    gone = {doc: set() for doc, _ in seqs}
    earlier = []
    for doc, lines in seqs:
        for s in range(len(lines)):
            for other in [*earlier, *[(lines, t) for t in range(s)]]:
                run, t = other
                n = words = 0
                while s + n < len(lines) and t + n < len(run) and lines[s + n][1] == run[t + n][1]:
                    words += len(lines[s + n][1].split())
                    n += 1
                if words >= min_words:
                    gone[doc].update(i for i, _ in lines[s:s + n])
        earlier += [(lines, t) for t in range(len(lines))]
    return {d: sorted(g) for d, g in gone.items()}


def test_line_runs_equal_brute_force(spark):
    rng = random.Random(5)
    lines = ["a", "b c", "d e f", "g", "h i", "long line of quite a few words here", "", "  "]
    texts = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    texts += [(100, "same\n" * 30), (101, texts[3][1]), (102, None), (103, ""), (104, texts[3][1] + "\nd e f\ng")]
    for min_words in (1, 4, 9):
        got = {r["doc_id"]: r["_gone"] or [] for r in line_runs.dedup_lines(docs_of(spark, texts), min_words).collect()}
        assert got == brute_gone(texts, min_words), min_words
        assert any(got.values())


def test_line_runs_keep_columns_first_copies_and_repeated_rows(spark):
    passage = "one two three\nfour five six"
    docs = docs_of(spark, [(1, passage), (2, "x\n" + passage), (2, "x\n" + passage), (3, None)])
    out = line_runs.dedup_lines(docs, 6)
    assert out.columns == [*docs.columns, "_gone"]
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"]) == [(1, passage), (2, "x"), (2, "x")]
    assert out.where("doc_id = 3 and text is null and _gone is null").count() == 1
    assert line_runs.dedup_lines(docs.limit(0), 6).count() == 0


def test_line_frequency_on_odd_input(spark):
    body = " ".join(f"w{i}" for i in range(30))
    own = [f"own{c}" for c in "abcdefghijkl"]
    texts = [(i, f"Shared  LINE {i}\n{body} {own[i]}") for i in range(12)]
    texts += [(50, None), (51, ""), (52, "too short"), (53, "Shared line 3\nq r s t u v w x y z" * 1), (None, body + " n"), (54, body + " n")]
    docs = docs_of(spark, texts, {53: None})
    docs = docs.union(docs.where("doc_id = 4"))
    verdicts, frequent = lf.line_frequency(docs, min_docs=5, share=0.1, min_left=10, min_left_share=0.3)
    got = {(r["doc_id"], r["n_words"]): r for r in verdicts.collect()}
    assert verdicts.count() == len(texts) + 1
    assert [(r["host"]) for r in frequent.collect()] == ["s"]  # digits are alike; the null host's line is its own
    assert got[0, 34]["left_words"] == 31 and got[0, 34]["kept"]
    assert got[50, 0]["base_failed"] and not got[50, 0]["kept"]
    assert got[53, 13]["left_words"] == 13
    kept = lf.kept_documents(docs, min_docs=5, share=0.1)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[0]["text"] == f"{body} owna" and rows[0]["n_chars"] == len(rows[0]["text"])
    assert kept.where("doc_id = 4").count() == 2 and 52 not in rows and None in rows
    assert lf.line_frequency(docs.limit(0))[0].count() == 0


def test_a_line_above_the_limit_depletes(spark):
    texts = [(i, "menu home about contact\nfew words left") for i in range(10)]
    verdicts, _ = lf.line_frequency(docs_of(spark, [(i, t + "\n" + f"a{i} b c d e f g h i j") for i, t in texts]), min_docs=5, share=0.1, min_left_share=0.9)
    assert verdicts.where("kept").count() == 0
    # exact copies are one document of their host, however many
    copies = docs_of(spark, [(i, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda") for i in range(20)])
    assert lf.line_frequency(copies, min_docs=5, share=0.1)[0].where("kept").count() == 20


def test_repeat_words_and_long_text(spark):
    words = ["a", "b", "c", "d", "e", "f"]
    text = " ".join(words * 3)
    long = " ".join(f"u{i}" for i in range(60_000)) + "\n" + " ".join(f"u{i}" for i in range(50))
    got = {r["doc_id"]: r["n_repeat_words"] for r in lf.line_frequency(docs_of(spark, [(1, text), (2, long)]))[0].collect()}
    assert got == {1: 18, 2: 100}
