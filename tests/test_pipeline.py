"""Invariants of the splits, the pipeline and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tabmill.operators import balance, split
from tabmill.plans import pipeline as P
from tabmill.plans import tune as TU
from tabmill.sources.assay import ASSAY_SPEC


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) == {"feature", "n_outliers", "lower", "upper"}


def test_every_key_has_sql_or_is_a_model_key():
    from tabmill.plans.catalog import QUERIES
    q, s = E.queries(), E.oracle_sql()
    rows_only = {k for k in QUERIES if k not in s}
    assert set(s) <= set(q)
    assert all(k.startswith(("fit_", "vote_", "tune_", "feature_", "task_results"))
               for k in rows_only), rows_only


def test_split_is_partition_independent(spark, sf_small):
    raw = P.assay_raw(spark, sf_small).select("id")
    a = {r["id"]: r["split"] for r in split.split_random(raw.repartition(1), "id").collect()}
    b = {r["id"]: r["split"] for r in split.split_random(raw.repartition(8), "id").collect()}
    assert a == b
    share = sum(v == "test" for v in a.values()) / len(a)
    assert 0.15 < share < 0.25


def test_stratified_split_shares(spark, sf_small):
    raw = P.assay_raw(spark, sf_small).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = split.split_stratified(raw, "id", "y").groupBy("y", "split").count().collect()
    by = {(r["y"], r["split"]): r["count"] for r in out}
    for cls in (0, 1):
        n = by[(cls, "test")] + by[(cls, "train")]
        assert by[(cls, "test")] == int(0.2 * n + 0.5)


def test_preprocess_same_at_one_and_eight_partitions(spark, sf_small):
    raw = P.assay_raw(spark, sf_small)
    a = P.preprocess(raw.repartition(1), ASSAY_SPEC, cut_lineage=False)
    b = P.preprocess(raw.repartition(8), ASSAY_SPEC, cut_lineage=False)
    assert a.kept == b.kept and a.corr_dropped == b.corr_dropped
    assert a.fences == b.fences and a.medians == b.medians


def test_search_draws_are_seeded():
    space = TU.space_for("RF", "regression")
    assert TU.search_space(space, 5, 42) == TU.search_space(space, 5, 42)
    assert TU.search_space(space, 5, 42) != TU.search_space(space, 5, 43)
    for d in TU.search_space(space, 20, 1):
        assert 50 <= d["numTrees"] <= 200 and 1 <= d["minInstancesPerNode"] <= 4


def test_smote_balances_and_interpolates(spark):
    rows = [(i, float(i % 7), float((i * 3) % 11), 1 if i % 5 == 0 else 0) for i in range(1, 201)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    syn, nb = balance.smote(df, "id", ["a", "b"], "y", k=3)
    n0, n1 = 160, 40
    assert syn.count() == n0 - n1
    assert nb.groupBy("id").count().where("count != 3").count() == 0
    # every synthetic point lies on the segment from its source to its neighbour
    src = df.select(F.col("id").alias("source_id"), F.col("a").alias("sa"), F.col("b").alias("sb"))
    nbr = df.select(F.col("id").alias("neighbor_id"), F.col("a").alias("na"), F.col("b").alias("nb"))
    chk = syn.join(src, "source_id").join(nbr, "neighbor_id").select(
        (F.abs(F.col("a") - (F.col("sa") + F.col("gap") * (F.col("na") - F.col("sa")))) < 1e-9).alias("ok_a"),
        (F.col("gap") >= 0) & (F.col("gap") < 1))
    assert all(all(r) for r in chk.collect())


def test_knn_chunked_equals_single_chunk(spark):
    rows = [(i, float((i * 13) % 17), float((i * 7) % 19)) for i in range(1, 120)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    one = {(r["id"], r["nb_rank"]): (r["nb_id"], r["dist"]) for r in
           balance.knn_self(df, "id", ["a", "b"], 4).collect()}
    many = {(r["id"], r["nb_rank"]): (r["nb_id"], r["dist"]) for r in
            balance.knn_self(df, "id", ["a", "b"], 4, chunk_rows=10, max_pivots=7).collect()}
    assert one == many


def test_fit_on_train_ignores_test_rows(spark, sf_small):
    """Changing only the holdout's rows changes no fitted value, unless the fit is on all rows."""
    from tabmill.functions.exprs import hash_uniform
    raw = P.assay_raw(spark, sf_small)
    test = hash_uniform("id", split.SEED) < split.TEST_FRACTION
    moved = raw.withColumn("ic50", F.when(test, F.col("ic50") * 100).otherwise(F.col("ic50")))
    a, b = P.logged_stage(raw, ASSAY_SPEC, fit_on="train"), P.logged_stage(moved, ASSAY_SPEC, fit_on="train")
    assert a[1] == b[1] and a[2] == b[2]
    assert P.logged_stage(raw, ASSAY_SPEC)[1] != P.logged_stage(moved, ASSAY_SPEC)[1]


def test_preprocess_passes_fit_on_to_every_fit(spark):
    """Fences, medians and modes of ``preprocess`` itself come from the train side alone, by default."""
    from tabmill.functions.exprs import hash_uniform
    from tabmill.spec import TableSpec
    spec = TableSpec("id", ["t"], ["f", "g"])
    rows = [(i, float(i % 97) + 1, float(i % 89), float((i * 7) % 83), "a" if i % 3 else None) for i in range(600)]
    raw = spark.createDataFrame(rows, "id long, t double, f double, g double, s string")
    raw = raw.withColumn("f", F.when(F.col("id") % 10 != 0, F.col("f")))
    test = hash_uniform("id", split.SEED) < split.TEST_FRACTION
    moved = raw.withColumns({"t": F.when(test, F.col("t") * 100).otherwise(F.col("t")), "f": F.when(test, F.col("f") + 1000).otherwise(F.col("f")),
                             "s": F.when(test, F.lit("z")).otherwise(F.col("s"))})
    a, b = P.preprocess(raw, spec), P.preprocess(moved, spec)
    assert a.fences == b.fences and a.medians == b.medians
    train = raw.where(~test)
    assert a.medians.values["f"] == train.selectExpr("percentile(f, 0.5)").first()[0]
    assert P.preprocess(raw, spec, fit_on="all").fences != P.preprocess(moved, spec, fit_on="all").fences
    out, _, _ = P.stage_clip_impute(moved, spec, "train")
    assert out.where(~test & (F.col("s") == "z")).count() == 0  # the test side's mode fills nothing
