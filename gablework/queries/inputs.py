"""Inputs that several queries share, as DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.functions import fold_of
from gablework.queries.registry import table

# The tables have no gaps, so gaps are made by the same rule on both sides.
GAPPY_SQL = """
SELECT event_id, user_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value
FROM events"""


def gappy_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


FOLD_SQL = "CAST('0x' || substr(md5('42:' || {key}), 1, 8) AS BIGINT) % 5"

# One row per order with lines: line count, quantity, balance, its thousands, log revenue, fold.
SALES_SQL = f"""
sales AS (
  SELECT o_orderkey AS k, CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS q,
         any_value(c_acctbal) AS bal, floor(any_value(c_acctbal) / 1000) AS band, ln(1 + sum(l_extendedprice * (1 - l_discount))) AS y,
         {FOLD_SQL.format(key="o_orderkey")} AS fold
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY o_orderkey)"""

FEATURES = ["n", "q"]
TREE_FEATURES = ["n", "q", "band"]  # few values each, so SQL can follow the trees


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Lines are summed per order before the joins, so the wide side never moves."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("l_quantity").alias("q"),
        F.log1p(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("y"),
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        customers, orders.o_custkey == customers.c_custkey
    )
    return joined.select(
        F.col("o_orderkey").alias("k"), "n", "q", "bal", F.floor(F.col("bal") / 1000).cast("double").alias("band"), "y", fold_of(F.col("o_orderkey")).alias("fold")
    )
