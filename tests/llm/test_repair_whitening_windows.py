"""Conversation repair, whitening and substring dedup against brute force, and their defined results on odd input."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.llm import conversation_repair as cr
from tabmill.llm import queries, whitening, window_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- substring dedup ----

def brute_windows(rows, width):
    texts, first = [(d, WORD.findall(t or "")) for d, t in rows], {}
    for d, w in texts:
        for i in range(len(w) - width + 1) if d is not None else ():
            key = tuple(w[i:i + width])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in texts:
        gone = {j for i in range(len(w) - width + 1) if d is not None and first[tuple(w[i:i + width])] < d for j in range(i, i + width)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def cut_rows(df, width):
    got = window_dedup.remove_repeats(df, width).collect()
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))  # maximal intervals
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got], key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_windows_equal_brute_force(spark, partitions):
    """With small Arrow batches every task hashes several pieces, each of which decides its own repeats."""
    rng = random.Random(13)
    passages = [[rng.choice("ab cd éf 中".split()) + str(rng.randint(0, 99)) for _ in range(rng.randint(13, 40))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = [rng.choice("the of a x".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((i - 5, rng.choice([" ", "\n", "  \t"]).join(words), "x", "y"))
    rows += [(200, "a " * 300, "", ""), (201, "a " * 500, "", ""), (202, None, "", ""), (None, rows[0][1], "", ""), (None, None, "", ""), (203, "", "", ""),
             (7, rows[3][1], "", ""), (7, "other words", "", ""), (7, "other words", "", ""), (204, "z" * 5000 + " " + rows[6][1], "", ""), (205, " \n\t ", "", ""),
             (206, "a\x1cb\x85 " * 20, "", ""), (207, "a\x1cb\x85\n" * 20, "", "")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, marks string").repartition(partitions)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "9")
    try:
        for width in (13, 3, 1):
            assert cut_rows(df, width) == brute_windows([r[:2] for r in rows], width)
    finally:
        spark.conf.set(key, before)


def test_windows_over_a_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute_windows([tuple(r) for r in df.select("doc_id", "text").collect()], 13)
    assert sum(w[2] for w in want) > 0
    assert cut_rows(df, 13) == want
    got = queries.QUERIES["op13_window_dedup"](spark, sf_small).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(
        (d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in want)


def test_windows_of_an_empty_table(spark):
    assert window_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_and_segments_do_not_change_hashes(monkeypatch):
    import pyarrow as pa
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["ab", "é", "w" * 70, "c\n"]) for _ in range(rng.randint(0, 90))) for _ in range(40)] + ["q" * 900, "", " "]
    batch = pa.RecordBatch.from_arrays([pa.array(["skipped", *texts])], ["text"]).slice(1)

    def windows(limit):
        return [(row + int(d), int(f), int(h), int(g)) for row, _, p in window_dedup._pieces(batch, 3, limit) for d, f, h, g in zip(p.doc, p.first, p.h, p.g)]
    whole = windows(1 << 20)
    monkeypatch.setattr(window_dedup, "SEGMENT_BYTES", 64)
    assert whole == windows(1 << 20) == windows(100) and len(whole) > 500
    sound = {}
    for d, f, h, g in whole:
        assert sound.setdefault((h, g), WORD.findall(texts[d])[f:f + 3]) == WORD.findall(texts[d])[f:f + 3]
    assert len({tuple(w) for w in sound.values()}) == len(sound)


# ---- conversation repair ----

def brute_parse(letters):
    """All edit lists up to the cost of deleting everything, tried one by one."""
    best = (4 * len(letters), "D" * len(letters))

    def go(i, state, cost, audit):
        nonlocal best
        if (cost, audit) > best and cost >= best[0] and not (cost == best[0] and audit < best[1]):
            return
        if cost > best[0]:
            return
        if i == len(letters) and state in ("", "a"):
            best = min(best, (cost, audit))
        if not audit.endswith("II"):
            go(i, "a" if state == "u" else "u", cost + 3, audit + "I")
        if i < len(letters):
            go(i + 1, state, cost + 4, audit + "D")
            if letters[i] != "d":
                t, role = 3 * letters[i].isupper(), letters[i].lower()
                for new in ("u", "a"):
                    if (new == "a") == (state == "u"):
                        go(i + 1, new, cost + t + (0 if role == new else 3), audit + ("K" if role == new else "R"))
                if role == "s" and state == "":
                    go(i + 1, "s", cost + t, audit + "K")
    go(0, "", 0, "")
    return best


def test_parse_equals_all_edit_lists():
    rng = random.Random(12)
    for n in list(range(6)) * 60:
        letters = "".join(rng.choice("dsuaxSUAXuaua") for _ in range(n))
        assert cr.parse(letters) == brute_parse(letters), letters
    cost, audit = cr.parse("ua" * 4000 + "uu")
    assert (cost, audit) == (3, "K" * 8001 + "R") and cr.parse("") == (0, "")


def test_every_split_gives_the_same_cell():
    rng = random.Random(3)
    for _ in range(40):
        letters = "".join(rng.choice("dsuaxSUAX") for _ in range(9))
        cells = {}
        for size in range(1, 10):
            for i in range(10 - size):
                j = i + size
                made = [cr.join(cells[i, k], cells[k, j]) for k in range(i + 1, j)] or [cr.ROW_CELLS[letters[i]]]
                assert all(m == made[0] for m in made)
                cells[i, j] = made[0]
        root = cr.join(cells[0, 9], cr.CLOSURE)
        assert cr.parse(letters) == min(root[e] for e in ((0, 0), (0, 3)) if e in root)


def plain_repair(rows):
    """One conversation's report by plain steps; rows are (turn, role, text)."""
    rows = sorted([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows],
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults, letters = set(), [], ""
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        first = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "d" if fault in ("blank", "duplicate") else first.upper() if fault else first
    cost, audit = brute_parse(letters) if len(letters) < 7 else cr.parse(letters)
    out, it, place = [], iter(rows), 0
    for e in audit:
        role, text = ("user", "assistant")[place % 2], ""
        if e != "I":
            _, own, text = next(it)
            if e == "D":
                continue
            if e == "K":
                role = own
        out.append(f"{role}:{text}")
        place += not (e == "K" and role[:1] == "s")
    initials = [r[1][:1] for r in rows]
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out)


def test_repair_equals_plain_steps(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "and", "", " \n", None, "Why?\t", "é 中.", "x" * 4000 + "."]), "k", 1))
    rows += [(99, i, ("user", "assistant")[i % 2], f"t{i}.", "k", 2) for i in range(0, 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, letter string, n int").repartition(5)
    report, repaired, digests = cr.repair(df)
    sha = {r["conv_id"]: r["repaired_sha256"] for r in digests.collect()}
    lines: dict = {}
    for r in sorted(repaired.collect(), key=lambda r: r["n"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    got = report.collect()
    assert len(got) == 62 and len(sha) == 62
    for r in got:
        want = plain_repair([x[1:4] for x in rows if x[0] == r["conv_id"]])
        assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], sha[r["conv_id"]]) == want[:8]
        assert lines.get(r["conv_id"], []) == want[8]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(r["conv_id"], [])))
    assert [f.count() for f in cr.repair(df.limit(0))] == [0, 0, 0]


def test_damage_and_whole_query(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t % 2], f"Text {t}. Done! Yes?") for c in range(40) for t in range(c % 5)] + [
        (None, 0, "user", None), (500, None, None, "x."), (501, 0, "user", "One."), (501, 0, "user", "One.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want: dict = {}
    for c, t, role, text in rows:
        kept = want.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(t, "user" if kind == 4 else role, text)] * (kind != 0) * (1 + (kind == 3))
    got = queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == plain_repair(want[r["conv_id"]])[:8]


# ---- whitening ----

def check_whitening(rows, vectors, components=32):
    """Rows of ``whiten`` against NumPy's eigendecomposition, up to signs."""
    x = np.floor(64 * np.array([v for _, v in vectors])).astype(np.int64) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(0)]
    z = (x - x.mean(0).round().astype(np.int64)).astype(float)
    z -= z.mean(0)
    cov = z.T @ z / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(components, int((values > 1e-13 * values[0]).sum()))
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == n * m and set(by) == {i for i, _ in vectors}
    got = np.array([[by[i][c + 1]["whitened"] for c in range(m)] for i, _ in vectors])
    want = z @ axes[:, :m] / np.sqrt(values[:m])
    sign = np.sign((got * want).sum(0))
    gap = np.abs(np.diff(values[:m + 1])) / values[0] if m < len(values) else np.abs(np.diff(np.append(values[:m], 0))) / values[0]
    clear = np.minimum(gap, np.append(1, gap[:-1])) > 1e-3
    assert np.abs(got * sign - want)[:, clear].max(initial=0) < 1e-6
    assert np.allclose([by[vectors[0][0]][c + 1]["explained"] for c in range(m)], values[:m] / np.trace(cov), rtol=1e-4)
    assert np.abs(got.T @ got / n - np.eye(m)).max() < 1e-8
    for (i, _), row in zip(vectors, x.tolist()):
        assert {r["deviation"] for r in by[i].values()} == {sum((n * a - s) ** 2 for a, s in zip(row, sums))}
    assert {r["n"] for r in rows} == {n} and all(r["identity_error"] < 1e-8 for r in rows)
    assert len({r["identity_error"] for r in rows}) == 1


def test_whitening_of_a_whole_table(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    check_whitening(queries.QUERIES["op11_whitening"](spark, sf_small).collect(), [(r["vec_id"], r["embedding"]) for r in rows])


def test_whitening_odd_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(90, 5)) * [1, 40, .5, 3, 1000]
    good = [(i, [*map(float, v), float(v[0] + v[1]), 7.0]) for i, v in enumerate(base)]  # a copy up to rounding, a constant
    odd = [(900, None), (901, [None] * 7), (902, [1.0, float("nan"), 0, 0, 0, 0, 0]), (903, [float("inf"), 1.0, 0, 0, 0, 0, 0]), (904, []), (905, [1.0, 2.0]), (906, [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0])]
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for i, v in good + odd],
                               "vec_id long, embedding array<double>, n string, component int").repartition(4)
    check_whitening(whitening.whiten(df).collect(), good)
    check_whitening(whitening.whiten(df, 2).collect(), good, 2)
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 3")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 900 and vec_id < 905")).count() == 0
    same = df.where("vec_id = 3").unionByName(df.where("vec_id = 3"))
    assert whitening.whiten(same).count() == 0  # copies have no variance


def test_large_and_repeated_entries(spark):
    rng = np.random.default_rng(1)
    vectors = [(i % 40, [float(a) * 1e9, float(b), 1e300]) for i, (a, b) in enumerate(rng.normal(size=(80, 2)))]
    rows = whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    assert len(rows) % 80 == 0 and all(math.isfinite(r["whitened"]) for r in rows)


def test_factors():
    rng = np.random.default_rng(7)
    for d, rank in ((1, 1), (6, 6), (20, 4)):
        b = rng.normal(size=(d, rank)) * np.logspace(0, 3, rank)
        factor = whitening.pivoted_cholesky(b @ b.T)
        assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, b @ b.T)
        values, axes = whitening.one_sided_jacobi(factor)
        assert np.allclose(axes.T @ axes, np.eye(rank)) and np.allclose(axes * values @ axes.T, b @ b.T)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
