"""The fact table of applications over the star schema, and its SQL twin.

``program`` is the customer's nation and ``area`` its region (both small dimensions);
``route`` is the order's priority, ``document`` its year and priority.  Fulfilled orders
count as admitted, open ones as rejected, others have no outcome.  A few scores are zero
or missing, as sources have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDINARY = "1-URGENT"
ROUTES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nations and regions are of fixed size; orders and customers meet by a shuffle when both are large
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    who = customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    year = F.year("o_orderdate")
    score = F.when(F.col("o_orderkey") % 97 == 0, F.lit(0.0)).when(F.col("o_orderkey") % 89 != 0, F.col("o_totalprice"))
    return orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        year.cast("string").alias("cycle"),
        F.concat_ws("-", year.cast("string"), F.col("o_orderpriority")).alias("document"),
        F.col("o_orderpriority").alias("route"),
        F.col("n_name").alias("program"),
        F.col("r_name").alias("area"),
        F.col("o_custkey").alias("person"),
        score.alias("score"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("admitted"),
        F.when(F.col("o_orderkey") % 5 != 0, 100000.0 + 1000 * (year - 1995)).alias("floor_score"),
        F.col("o_orderkey").alias("row_seq"),
    )


APPS = """
apps AS (
  SELECT cast(year(o_orderdate) AS VARCHAR) AS cycle,
         cast(year(o_orderdate) AS VARCHAR) || '-' || o_orderpriority AS document,
         o_orderpriority AS route, n_name AS program, r_name AS area, o_custkey AS person,
         CASE WHEN o_orderkey % 97 = 0 THEN 0.0 WHEN o_orderkey % 89 <> 0 THEN o_totalprice END AS score,
         CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS admitted,
         CASE WHEN o_orderkey % 5 <> 0 THEN 100000.0 + 1000 * (year(o_orderdate) - 1995) END::DOUBLE AS floor_score,
         o_orderkey AS row_seq
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PERCENTILES = """
pct AS (
  SELECT a.*, CASE WHEN score IS NOT NULL AND count(score) OVER (PARTITION BY document, program) >= 5
                   THEN 100.0::DOUBLE * (rank() OVER (PARTITION BY document, program ORDER BY score NULLS LAST) - 1)
                        / count(score) OVER (PARTITION BY document, program) END AS percentile
  FROM apps a)"""

SUMMARY = f"""
summary AS (
  SELECT cycle, program, count(*) AS applications, count(*) FILTER (WHERE admitted) AS admitted,
         100.0::DOUBLE * count(*) FILTER (WHERE NOT admitted) / count(*) AS pct_rejected,
         min(score) FILTER (WHERE admitted AND route = '{ORDINARY}' AND score <> 0) AS cutoff_score,
         min(percentile) FILTER (WHERE admitted AND route = '{ORDINARY}') AS cutoff_percentile,
         arg_min(floor_score, row_seq) FILTER (WHERE floor_score IS NOT NULL) AS floor_score,
         min(score) FILTER (WHERE score <> 0) AS min_score, max(score) FILTER (WHERE score <> 0) AS max_score,
         median(score) FILTER (WHERE score <> 0) AS median_score
  FROM pct WHERE admitted IS NOT NULL GROUP BY ALL),
gold AS (
  SELECT *, pct_rejected >= 25 AS trusted,
         CASE WHEN applications >= 15 AND pct_rejected >= 25 THEN 100.0::DOUBLE * admitted / applications END AS admission_rate,
         CASE WHEN cycle >= '2024' THEN 'nueva' ELSE 'anterior' END AS scale FROM summary)"""
