"""Sampling against true similarity, classes against brute force, odd input."""

import random

import numpy as np

from tabmill.llm import minhash_icws as mh


def test_samples_agree_like_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
    got, want = [], []
    for trial in range(60):
        wa, wb = rng.uniform(0.2, 3, 400), rng.uniform(0.2, 3, 400)
        wa[:trial], wb[-trial:] = 1e-6, 1e-6
        h2 = h + np.uint64(trial * 7919)
        s = mh.samples(np.concatenate([h2, h2]), np.concatenate([wa, wb]), np.array([0, 400]))
        got.append((s[0] == s[1]).mean())
        want.append(np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
    assert abs(np.mean(got) - np.mean(want)) < 0.03


def make_docs(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(3000)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(40, 120))] for _ in range(30)]
    texts = {}
    for i in range(300):
        words = list(bases[i % 30])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 12])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i] = " ".join(words)
    texts[300], texts[301], texts[302], texts[303] = None, "", "only three words", "ONLY  three\twords"
    return texts


def brute_classes(texts, idf):
    import re
    sets = {}
    for i, t in texts.items():
        t = re.sub(r"[\x20\x09-\x0D]+", " ", t or "").lower().strip(" ")
        if t:
            h, tf = mh.shingles(t)
            sets[i] = (h, mh.weights(h, tf, idf))
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and mh.similarity(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in texts}


def test_classes_equal_brute_force(spark):
    texts = make_docs()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], "doc_id long, text string, key string, t string")
    got = {r["doc_id"]: r["class_id"] for r in mh.near_duplicates(docs).collect()}
    from pyspark.sql import functions as F
    normal = docs.select(F.coalesce(mh.normal_line(F.col("text")), F.lit("")).alias("t"))
    assert got == brute_classes(texts, mh.idf_table(normal, docs.count()))
    kept = mh.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c in got.values()})


def test_idf_counts_all_documents(spark):
    docs = spark.createDataFrame([("a b c d e",)] * 64 + [("v w x y z",)], "t string")
    idf = mh.idf_table(docs, 65)
    slot = lambda t: int(mh.shingles(t)[0][0] >> np.uint64(64 - mh.DF_BITS))
    assert idf[slot("a b c d e")] < 5 and idf[slot("v w x y z")] > 240


def test_nulls_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, None), (8, " ")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in mh.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5), (5, 5), (8, 8), (9, 9), (None, 5)]
    assert sorted(r["doc_id"] for r in mh.one_per_class(docs).collect()) == [5, 8, 9]
    assert mh.near_duplicates(docs.limit(0)).count() == 0


def test_distinct_texts_under_null_and_repeated_ids_stay(spark):
    rng = random.Random(9)
    texts = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(30)) for _ in range(7)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2].upper()), (7, texts[3]), (7, texts[4]), (8, texts[4]), (None, texts[5]), (3, texts[5]), (4, texts[6])]
    kept = mh.one_per_class(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["text"].lower()) for r in kept.collect()), key=str)
    assert got == sorted([(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (3, texts[5]), (4, texts[6])], key=str)
