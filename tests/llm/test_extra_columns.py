"""Extra columns called like the operators' own ones come out as they went in."""

import pytest
from pyspark.sql import functions as F

from tabmill.llm import line_frequency, line_runs, minhash_icws
from tabmill.llm import mix_hierarchy as mix

OWN = ("_k _h _gone __lines __gone __k __kh __kt __host __hash __all __worded _id _key _own _n _epoch _tokens _source full "
       "cut_h cut_id cut_in __full __cut_h __n key label n text_hash host gone lines h g k bucket tokens docs budget root").split()
PASSAGE = "one two three four five\nsix seven eight nine ten"
TEXTS = [PASSAGE, "x y\n" + PASSAGE, " ".join(f"w{i}" for i in range(30)), "a line of its own that stays here", None, ""]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", len(t or ""), *[f"{c}-{i}" for c in OWN]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in OWN))


def same(out, docs, left):
    """The rows of ``out`` by doc_id, each with its own extra columns."""
    assert [c for c in out.columns if c in docs.columns] == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert sorted(rows) == left
    assert all(r[c] == f"{c}-{i}" for i, r in rows.items() for c in OWN)
    return rows


def test_line_runs(docs):
    out = line_runs.dedup_lines(docs, 6)
    assert len(out.columns) == len(docs.columns) + 1
    rows = same(out, docs, list(range(6)))
    assert rows[1]["text"] == "x y" and rows[0]["text"] == PASSAGE and rows[1][out.columns[-1]] == [1, 2]


def test_line_frequency(docs):
    out = line_frequency.kept_documents(docs, min_docs=1, share=0.2, min_left=1, min_left_share=0.05)
    assert out.columns == docs.columns
    # document 0 is nothing but frequent lines; 3 is too short
    rows = same(out, docs, [1, 2])
    assert rows[1]["text"] == "x y" and rows[1]["n_chars"] == 3


def test_near_duplicates(docs):
    both = docs.unionByName(docs.where("doc_id = 2").withColumn("doc_id", F.lit(9).cast("long")))
    out = minhash_icws.one_per_class(both)
    assert out.columns == docs.columns
    same(out, docs, list(range(6)))


def test_mix(docs):
    out = mix.mix(docs, {"source": F.col("source")}, {}, 1.0, 1)
    assert {c for c in out.columns if c not in docs.columns} == {"__epoch", "__source", "__tokens"}
    rows = {r["doc_id"]: r for r in out.collect()}
    assert sorted(rows) == list(range(6)) and all(r[c] == f"{c}-{i}" for i, r in rows.items() for c in OWN)
    assert all(r["__epoch"] == 0 and r["__source"] == "s" for r in rows.values())
