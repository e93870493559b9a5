"""The ``assay`` table: a wide numeric table built from the TPC-H-like test
tables, one row per order, with three positive targets and fifteen
features. Orders without line items keep NULL features, which gives real
missing cells. The same definition in SQL lives in ``ASSAY_SQL``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.sources.tables import normalise_missing, read_table
from tabmill.spec import TableSpec

TARGETS = ["ic50", "cc50", "si"]
FEATURES = ["acctbal", "nation", "n_lines", "sum_qty", "sum_price", "avg_price",
            "max_price", "avg_disc", "avg_tax", "n_parts", "avg_size",
            "avg_retail", "share_ret", "yr"]
ASSAY_SPEC = TableSpec(id="id", targets=TARGETS, features=FEATURES)


def assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the fixture. Line items are reduced to one row per order before
    meeting ``orders`` (map-side partial aggregation, so the shuffle carries
    at most one row per order per task); both joins are on the keys Spark
    already hash-partitions by, and AQE picks broadcast for a dimension only
    when its measured size is under the threshold."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")

    # Money columns carry two decimals; summing them as integer cents (and
    # the discounted price as integer 1e-4 units) makes every sum exact, so
    # the result does not depend on the order rows meet in a task.
    def cents(c):
        return F.round(F.col(c) * 100).cast("bigint")

    n = F.count(F.lit(1))
    # The distinct part count is kept out of the wide aggregate: a
    # count(DISTINCT) there would shuffle every partial column twice (once
    # on (order, part), once on order). On its own it shuffles two bigint
    # columns, combined map-side per (order, part) and then per order, and
    # both sides end hash-partitioned on l_orderkey, so their join adds no
    # exchange.
    n_parts = (li.select("l_orderkey", "l_partkey").where(F.col("l_partkey").isNotNull())
               .distinct()
               .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_parts")))
    lines = (li.join(part, li.l_partkey == part.p_partkey, "left")
             .groupBy("l_orderkey")
             .agg((F.sum(cents("l_extendedprice") * (100 - cents("l_discount"))) / 10000.0)
                  .alias("ic50"),
                  n.alias("n_lines"),
                  F.sum("l_quantity").alias("sum_qty"),
                  (F.sum(cents("l_extendedprice")) / 100.0).alias("sum_price"),
                  (F.sum(cents("l_extendedprice")) / 100.0 / n).alias("avg_price"),
                  F.max("l_extendedprice").alias("max_price"),
                  (F.sum(cents("l_discount")) / 100.0 / n).alias("avg_disc"),
                  (F.sum(cents("l_tax")) / 100.0 / n).alias("avg_tax"),
                  (F.sum("p_size") / F.count("p_size")).alias("avg_size"),
                  (F.sum(cents("p_retailprice")) / 100.0 / F.count("p_retailprice"))
                  .alias("avg_retail"),
                  (F.count_if(F.col("l_returnflag") == "R") / n).alias("share_ret"))
             .join(n_parts, "l_orderkey", "left")
             .withColumn("n_parts", F.coalesce("n_parts", F.lit(0)).cast("bigint")))
    # Customers meet the narrow order columns first, so the wide line
    # aggregate is joined last, on the order key: the result stays
    # hash-partitioned by id, which is all a whole-row deduplication
    # downstream needs (no second shuffle of the wide table).
    df = (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
          .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    out = df.select(
        F.col("o_orderkey").alias("id"),
        F.col("ic50"),
        F.col("o_totalprice").alias("cc50"),
        F.try_divide(F.col("o_totalprice"), F.col("ic50")).alias("si"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_nationkey").alias("nation"),
        *[F.col(c) for c in FEATURES[2:-1]],
        F.year("o_orderdate").cast("int").alias("yr"),
    )
    return normalise_missing(out)


# The same table in SQL, for the DuckDB oracle (tables are registered views).
ASSAY_SQL = """
assay_lines AS (
  SELECT l.l_orderkey,
         sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)
             * (100 - CAST(round(l.l_discount * 100) AS BIGINT))) / 10000.0 AS ic50,
         count(*) AS n_lines,
         sum(l.l_quantity) AS sum_qty,
         sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) / 100.0 AS sum_price,
         sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) / 100.0 / count(*) AS avg_price,
         max(l.l_extendedprice) AS max_price,
         sum(CAST(round(l.l_discount * 100) AS BIGINT)) / 100.0 / count(*) AS avg_disc,
         sum(CAST(round(l.l_tax * 100) AS BIGINT)) / 100.0 / count(*) AS avg_tax,
         count(DISTINCT l.l_partkey) AS n_parts,
         sum(p.p_size) / count(p.p_size) AS avg_size,
         sum(CAST(round(p.p_retailprice * 100) AS BIGINT)) / 100.0 / count(p.p_retailprice)
             AS avg_retail,
         count(*) FILTER (WHERE l.l_returnflag = 'R') / count(*) AS share_ret
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
assay AS (
  SELECT o.o_orderkey AS id, a.ic50, o.o_totalprice AS cc50,
         o.o_totalprice / nullif(a.ic50, 0) AS si,
         c.c_acctbal AS acctbal, c.c_nationkey AS nation,
         a.n_lines, a.sum_qty, a.sum_price, a.avg_price, a.max_price,
         a.avg_disc, a.avg_tax, a.n_parts, a.avg_size, a.avg_retail,
         a.share_ret, CAST(year(o.o_orderdate) AS INTEGER) AS yr
  FROM orders o
  LEFT JOIN assay_lines a ON o.o_orderkey = a.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""
