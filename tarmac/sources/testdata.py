"""The ``flights`` view over the TPC-H-like test tables.

One flight per ``lineitem`` row: origin = supplier's nation, destination =
customer's nation (through the order), carrier = part brand.  Delays are
whole numbers, so means agree bit for bit with any other engine.

Join order is chosen for size: the three lookups are each reduced to
(key, value) before meeting ``lineitem``, and ``orders`` meets
``customer`` first, so ``lineitem`` itself is joined on ``l_orderkey``
(sort-merge against the reduced order table) and on two small keyed
tables whose broadcast AQE decides from measured sizes.  ``nation`` is
the only side that is small by definition (25 rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.columns import to_double

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flights_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated flights (schema ``tarmac.schema.FLIGHTS``) from the test tables."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_shipdate")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dest_of_order = (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(nation.withColumnRenamed("n_name", "dest"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "dest"))
    origin_of_supplier = (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(nation.withColumnRenamed("n_name", "origin"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "origin"))
    carrier_of_part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("unique_carrier"))

    minute = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211) % 1440
    cancelled = F.col("l_tax") == F.lit(0.08)
    return (
        li.join(dest_of_order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(origin_of_supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(carrier_of_part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.to_date("l_shipdate").alias("flight_date"),
            (F.weekday("l_shipdate") + 1).alias("day_of_week"),
            "unique_carrier",
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("flight_num"),
            "origin",
            "dest",
            F.concat(F.lpad((minute / 60).cast("int").cast("string"), 2, "0"),
                     F.lpad((minute % 60).cast("string"), 2, "0")).alias("crs_dep_time"),
            F.when(~cancelled, to_double(F.col("l_quantity").cast("int") - 15)).alias("dep_delay"),
            F.when(~cancelled, to_double(F.floor("l_extendedprice").cast("bigint") % 121 - 30))
            .alias("arr_delay"),
        ))


# The same view in DuckDB SQL, used by the oracle queries.
FLIGHTS_SQL = """
flights AS (
  SELECT
    CAST(l.l_shipdate AS DATE) AS flight_date,
    CAST(isodow(l.l_shipdate) AS INTEGER) AS day_of_week,
    p.p_brand AS unique_carrier,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS flight_num,
    ns.n_name AS origin,
    nc.n_name AS dest,
    lpad(CAST(((l.l_orderkey * 37 + l.l_linenumber * 211) % 1440) // 60 AS VARCHAR), 2, '0')
      || lpad(CAST(((l.l_orderkey * 37 + l.l_linenumber * 211) % 1440) % 60 AS VARCHAR), 2, '0')
      AS crs_dep_time,
    CASE WHEN l.l_tax = 0.08 THEN NULL
         ELSE CAST(CAST(l.l_quantity AS INTEGER) - 15 AS DOUBLE) END AS dep_delay,
    CASE WHEN l.l_tax = 0.08 THEN NULL
         ELSE CAST(CAST(floor(l.l_extendedprice) AS BIGINT) % 121 - 30 AS DOUBLE) END AS arr_delay
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""
