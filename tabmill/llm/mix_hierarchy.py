"""Mixing sources to target weights by hierarchical budgeting.

Sources are the leaves of a tree (domain, language, source). A token budget flows from the root: each node shares its
budget among its children in proportion to their weights, but a child gets at most what its leaves can give (their
tokens times ``max_epochs``); what it cannot use goes to its siblings, by weight, and only what all siblings together cannot use
leaves for the parent's siblings. This is a water level per family, found with sums over the children sorted by capacity
per weight. A leaf with budget a and t tokens is read a // t times whole; the rest is the prefix, in whole documents
and never beyond the budget, of one more epoch, whose order is a hash of (doc_id, seed, epoch).

Defined results: a null level is a child named ''; a null text has no tokens; a weight of 0 gives nothing; rows of the same
doc_id stand together in an epoch's order and are taken together; a leaf without tokens gives nothing; an empty table gives an
empty result; other columns are kept by ``mix``, which adds ``_epoch``, whatever their names.

Scale: documents are reduced map-side to leaves, then to hash buckets of about ``BUCKET_DOCS`` documents of a leaf; only the
bucket in which a leaf's prefix ends is sorted, so a leaf with a third of all rows takes no window of its own size. The result
is a filter against one row per leaf, so the documents are not shuffled as long as Spark finds the leaves small enough
to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.common import Stages, free_names, words

SEED, BUCKET_DOCS, HASH_BITS = 17, 4096, 60


def token_estimate(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def epoch_hash(doc_id: Column, seed: int, epoch: Column) -> Column:
    """60 bits, equal on any partitioning."""
    text = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(str(seed)), epoch.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def share_out(children: DataFrame, family: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to children (family columns, name, w, cap, parent_budget) by the family's water level."""
    children = children.withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")))
    order = Window.partitionBy(*family).orderBy(F.col("ratio").asc_nulls_last(), name)
    used = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    children = children.withColumn("level", F.when(F.col("w") > 0, (F.col("parent_budget") - used) / weight))
    full = F.col("cap") <= F.col("w") * F.col("level")
    # the first child that is not full sets the level of all that follow; the levels computed there only fall
    level = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy(*family))
    budget = F.when(full, F.col("cap").cast("double")).otherwise(F.greatest(F.col("w") * level, F.lit(0.0)))
    return children.withColumn("budget", F.coalesce(budget, F.lit(0.0))).drop("ratio", "level", "parent_budget")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[int, dict[tuple, float]], budget_share: float, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens, docs) with ``budget``, in total all tokens times ``budget_share``. ``weights``: by depth
    (1: the children of the root), of children named by the last one or more names of their path; 1 where none is given."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens").alias("t"), F.sum("cap").alias("c")).select(
        F.least(F.col("t") * budget_share, F.col("c").cast("double")).alias("budget"))
    parents = total.withColumn("root", F.lit(0))
    family = ["root"]
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.withColumn("root", F.lit(0)).groupBy("root", *path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.join(parents.withColumnRenamed("budget", "parent_budget"), family)
        w = F.coalesce(*[F.when(F.array(*[F.col(c) for c in path[-len(p):]]) == F.array(*map(F.lit, p)), F.lit(float(x)))
                         for p, x in weights.get(depth, {}).items()], F.lit(1.0))
        nodes = nodes.withColumn("w", w)
        parents = share_out(nodes, family, path[-1]).select("root", *path, "budget")
        family = ["root", *path]
    return leaves.join(parents.drop("root"), levels).drop("cap")


def plan(narrow: DataFrame, levels: list[str], weights: dict[int, dict[tuple, float]], budget_share: float, max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf that gives anything: levels, full (whole epochs), and of the next epoch the last (hash, doc_id) taken
    (cut_h, cut_id; cut_h -1: none). ``narrow``: doc_id, levels, n_tokens."""
    leaves = narrow.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaf_budgets(leaves, levels, weights, budget_share, max_epochs).where("tokens > 0")
    leaves = leaves.withColumn("full", F.floor(F.col("budget") / F.col("tokens") + 1e-9))
    leaves = leaves.withColumn("rest", F.floor(F.col("budget") - F.col("full") * F.col("tokens") + 1e-6))
    bits = F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / BUCKET_DOCS)))).cast("int")
    stages = Stages(narrow.sparkSession, "mix")
    leaves = stages.write(leaves.withColumn("width", F.pow(F.lit(2.0), HASH_BITS - bits).cast("long")), "leaves")
    due = narrow.join(leaves.where("rest > 0").select(*levels, "full", "rest", "width"), levels)
    due = due.withColumn("h", epoch_hash(F.col("doc_id"), seed, F.col("full")))
    due = due.withColumn("bucket", ((F.col("h") - F.pmod("h", "width")) / F.col("width")).cast("long"))
    sums = due.groupBy(*levels, "bucket", "rest", "width").agg(F.sum("n_tokens").alias("t"))
    upto = F.sum("t").over(Window.partitionBy(*levels).orderBy("bucket"))
    cut = sums.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy(*levels, "rest", "width").agg(
        F.min(F.struct("bucket", "upto", "t")).alias("c"))
    cut = stages.write(cut.select(*levels, F.col("c.bucket").alias("bucket"), (F.col("rest") - F.col("c.upto") + F.col("c.t")).alias("room"),
                                  (F.col("c.bucket") * F.col("width")).alias("from_h")), "cut")
    id_order = F.struct("h", "doc_id")
    last = due.join(cut, [*levels, "bucket"])
    last = last.withColumn("upto", F.sum("n_tokens").over(Window.partitionBy(*levels).orderBy("h", "doc_id")))
    last = last.where(F.col("upto") <= F.col("room")).groupBy(*levels).agg(F.max(id_order).alias("last"))
    plans = leaves.join(cut, levels, "left").join(last, levels, "left")
    # no bucket exceeds the rest: the whole epoch fits, which floor() leaves to a rest of all tokens less rounding
    whole = (F.col("rest") > 0) & F.col("bucket").isNull()
    return stages.write(plans.select(
        *levels, "full",
        F.when(whole, F.lit(2**HASH_BITS)).when(F.col("rest") <= 0, F.lit(-1)).otherwise(
            F.coalesce(F.col("last.h"), F.col("from_h") - 1)).cast("long").alias("cut_h"),
        F.when(~whole, F.col("last.doc_id")).alias("cut_id"), F.col("last").isNotNull().alias("cut_in")), "plan")


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[int, dict[tuple, float]], budget_share: float, max_epochs: int,
        seed: int = SEED, tokens: Column | None = None) -> DataFrame:
    """``docs`` as often as it is drawn, with ``_tokens``, ``_epoch`` (from 0) and the levels as ``_<name>``; with more
    underscores, all of them, where ``docs`` has a column of such a name."""
    tokens = token_estimate(F.col("text")) if tokens is None else tokens
    size, epoch, *names = free_names(docs, "_tokens", "_epoch", *[f"_{n}" for n in levels])
    docs = docs.withColumns({n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(names, levels.values(), strict=True)} | {size: tokens})
    narrow = Stages(docs.sparkSession, "mix").write(docs.select("doc_id", *names, F.col(size).alias("n_tokens")), "tokens")
    drawn = plan(narrow, names, weights, budget_share, max_epochs, seed)
    full, cut_h, cut_id, cut_in, n = free_names(docs, "__full", "__cut_h", "__cut_id", "__cut_in", "__n")
    out = docs.join(drawn.withColumnsRenamed({"full": full, "cut_h": cut_h, "cut_id": cut_id, "cut_in": cut_in}), names)
    h = epoch_hash(F.col("doc_id"), seed, F.col(full))
    more = (h < F.col(cut_h)) | ((h == F.col(cut_h)) & (~F.col(cut_in) | F.coalesce(F.col("doc_id") <= F.col(cut_id), F.col("doc_id").isNull())))
    out = out.withColumn(n, F.col(full).cast("int") + more.cast("int")).where(F.col(n) > 0)
    return out.withColumn(epoch, F.explode(F.sequence(F.lit(0), F.col(n) - 1))).drop(full, cut_h, cut_id, cut_in, n)
