"""The prefix forest against brute force; the mix against a plain version; the pipeline's stages."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tabmill.llm import mix_hierarchy as mix
from tabmill.llm import prefix_forest


def test_neighbours_with_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16)).astype(np.float32) * rng.uniform(0.5, 2, (400, 1)).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], "z") for i in range(400)]
    rows += [(1000 + i, [float(v) for v in x[7]], "z") for i in range(60)]  # copies
    rows += [(2000, None, "z"), (2001, [0.0] * 16, "z"), (2002, [1.0] * 15 + [None], "z"), (2003, [1.0] * 15 + [float("nan")], "z"), (2004, [1.0] * 5, "z"), (None, [1.0] * 16, "z"), (3, rows[3][1], "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep string")
    got = {}
    for r in prefix_forest.neighbours(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids = np.array([*range(400), *range(1000, 1060)])
    m = np.vstack([x, np.repeat(x[7:8], 60, axis=0)]).astype(np.float64)
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    hits = total = 0
    for q, found in got.items():
        scores = (m * m[ids == q][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:20]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        for _, v, s in found:
            assert s == scores[ids == v][0]
        hits += len({v for _, v, _ in found} & set(ids[order].tolist()))
        total += 20
    assert hits / total >= 0.9
    assert prefix_forest.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = prefix_forest.neighbours(df.where("vec_id < 5"), F.col("vec_id") == 0, 20).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]


def test_blocks_split_and_short_queries_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "BLOCK", 8)
    rng = np.random.default_rng(6)
    base = rng.normal(size=8)
    x = np.vstack([base + rng.normal(size=(60, 8)) * 1e-9, rng.normal(size=(60, 8))])  # 60 vectors share their strings
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = prefix_forest.neighbours(df, F.col("vec_id") % 20 == 0, 20)
    assert got.groupBy("query_id").count().where("count = 20").count() == 6


def test_queries_ascend_past_their_blocks(spark, monkeypatch):
    """Unit vectors close to uniform on the sphere, as the given ones, in some dozens of blocks per tree."""
    monkeypatch.setattr(prefix_forest, "BLOCK", 16)
    monkeypatch.setattr(prefix_forest, "PER_TREE", 200)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    asked = range(0, 500, 20)
    found = {}
    for r in prefix_forest.neighbours(df, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in asked:
        scores = x.astype(np.float64) @ x[q].astype(np.float64)
        scores[q] = -2
        hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * len(asked)) >= 0.95


def plain_mix(rows, weights, share, epochs, seed):
    """rows: (doc_id, a, b, tokens). Budgets by water-filling, level by level, then prefixes."""
    def fill(children, budget):
        got, open_ = {}, dict(children)
        while open_:
            level = budget / sum(w for _, w in open_.values())
            full = {k for k, (cap, w) in open_.items() if cap <= w * level}
            if not full:
                return {**got, **{k: w * level for k, (_, w) in open_.items()}}
            for k in full:
                got[k] = open_.pop(k)[0]
                budget -= got[k]
        return got

    caps = {}
    for _, a, b, t in rows:
        caps.setdefault(a, {}).setdefault(b, 0)
        caps[a][b] += t * epochs
    total = sum(t for *_, t in rows)
    out = []
    top = fill({a: (sum(c.values()), weights.get((a,), 1.0)) for a, c in caps.items()}, min(total * share, total * epochs))
    for a, c in caps.items():
        for b, budget in fill({b: (cap, 1.0) for b, cap in c.items()}, top[a]).items():
            leaf = [(i, t) for i, x, y, t in rows if (x, y) == (a, b)]
            tokens = sum(t for _, t in leaf)
            full = int(budget / tokens + 1e-9)
            rest = int(budget - full * tokens + 1e-6)
            for e in range(full):
                out += [(i, e) for i, _ in leaf]
            used = 0
            for i, t in sorted(leaf, key=lambda x: int(hashlib.md5(f"{x[0]}:{seed}:{full}".encode()).hexdigest()[:15], 16)):
                used += t
                if rest and used <= rest:
                    out.append((i, full))
    return sorted(out)


def test_mix_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(mix, "BUCKET_DOCS", 4)
    rows = [(i, "ab"[i % 7 == 0], f"s{i % 5}" if i % 3 else "s0", 5 + i % 11) for i in range(300)]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, a string, b string, n long, text string, full long").drop("full")
    for share, epochs in ((0.3, 1), (0.9, 2), (1.7, 3)):
        out = mix.mix(df, {"a": F.col("a"), "b": F.col("b")}, {1: {("a",): 1.0, ("b",): 3.0}}, share, epochs, tokens=F.col("n"))
        got = sorted((r["doc_id"], r["_epoch"]) for r in out.collect())
        assert got == plain_mix(rows, {("a",): 1.0, ("b",): 3.0}, share, epochs, mix.SEED)


def test_mix_odd_input(spark):
    df = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, "c d", "s"), (3, None, "s"), (4, "", "t")], "doc_id long, text string, source string")
    out = mix.mix(df, {"source": F.col("source")}, {}, 1.0, 1)
    assert out.select("doc_id", "_epoch").count() == 4  # the leaf without tokens gives nothing
    assert mix.mix(df.limit(0), {"source": F.col("source")}, {}, 1.0, 1).count() == 0


def test_pipeline_equals_its_parts(spark, sf_small):
    """Rows of the pipeline on the small tables, against plain Python where a stage's decision is plain."""
    import base64

    import public_tokenizers as P
    import tiktoken

    import corpus_pipeline
    from tabmill.llm.common import Stages
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    stages, seen = Stages(spark, "t"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stages.write(stage(spark, seen[-1], sf_small), name))
    for before, after in zip(seen[:4], seen[1:5]):
        assert after.columns == docs.columns
        assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0
        assert after.where("n_chars <> length(text)").count() == 0 or after is seen[1]
    from test_line_operators import brute_gone
    rows = [(r["doc_id"], r["text"]) for r in seen[1].collect()]
    gone = brute_gone(rows, 50)
    want = {}
    for i, t in rows:
        left = "\n".join(s for n, s in enumerate(t.split("\n")) if n not in set(gone[i]))
        if left.split() or not gone[i]:
            want[i] = left
    assert {r["doc_id"]: r["text"] for r in seen[2].collect()} == want
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {r["doc_id"]: len(library.encode_ordinary(r["text"])) for r in seen[4].collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in seen[5].collect()} == want and want
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_small).collect()} == set(want)
