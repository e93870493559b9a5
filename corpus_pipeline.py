"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing to target weights, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept. ``run`` writes every stage's result as Parquet to the shared folder and gives the reread table to the next. All
stages but the last return the columns of ``documents`` (extra columns are carried along, in their order)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import bpe_bitmap, line_frequency, line_runs, minhash_icws, mix_hierarchy
from tabmill.llm.common import Stages, words
from tabmill.llm.queries import MIX_SHARE, MIX_WEIGHTS, mix_levels

#: Documents are not repeated in the pipeline: near-dedup has just left one of each.
MIX_EPOCHS = 1


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` with another text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return docs.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others the lines above their host's limit go."""
    return line_frequency.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which no word is left."""
    out = line_runs.dedup_lines(docs)
    gone = out.columns[-1]
    emptied = F.col(gone).isNotNull() & (F.size(words(F.col("text"))) == 0)
    return _with_text(out.where(~emptied).drop(gone), F.col("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id stays."""
    return minhash_icws.one_per_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights."""
    drawn = mix_hierarchy.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_bitmap.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("tokens", tokens)]

#: Near-dedup and BPE are beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = Stages(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
