"""Sources and sinks, projections, filters, unions and keyed joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.functions import differs, fold_of, log1p_or_null, present, weighted_sum
from gablework.models.folds import BLEND_FIVE, blend
from gablework.operators import profile, rows
from gablework.queries.inputs import FOLD_SQL, GAPPY_SQL, gappy_events
from gablework.queries.registry import neat, query, r, table
from gablework.shared import numeric_columns, scratch_path
from gablework.sources import housing


@query("csv_scan", f"""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {r('c_acctbal', 2)} END AS c_acctbal
FROM customer""")
def csv_scan(spark, d):
    """A CSV with texts that mean missing, written and read back with a fixed schema."""
    c = table(spark, d, "customer")
    path = scratch_path(spark, "csv")
    out = c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.lit("NA")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("null")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
    )
    housing.write_table(out, path, "csv")
    wanted = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ])
    return neat(housing.read_csv(spark, path, wanted), 2)


@query("target_column", f"SELECT o_orderkey, {r('ln(1 + o_totalprice)')} AS y FROM orders")
def target_column(spark, d):
    pair = housing.read_target(spark, f"{d}/orders.parquet", "o_orderkey", "o_totalprice")
    return neat(pair.select("o_orderkey", log1p_or_null(F.col("o_totalprice")).alias("y")))


@query("blend_submission", f"""
SELECT o_orderkey, {r('''exp(0.1 * ln(1 + o_totalprice) + 0.1 * ln(1 + o_totalprice * 1.1) + 0.3 * ln(1 + o_totalprice * 0.9)
  + 0.3 * ln(1 + o_totalprice * 1.05) + 0.2 * ln(1 + o_totalprice * 0.95)) - 1''', 2)} AS price FROM orders""")
def blend_submission(spark, d):
    """Five prediction columns blended, brought back to prices, written and read as the result file."""
    factors = {"ridge": 1.0, "lasso": 1.1, "xgb": 0.9, "lgb": 1.05, "stacking": 0.95}
    o = table(spark, d, "orders")
    scored = o.select("o_orderkey", *[F.log1p(F.col("o_totalprice") * f).alias(n) for n, f in factors.items()])
    path = scratch_path(spark, "submission")
    housing.write_submission(housing.submission(scored, "o_orderkey", blend(BLEND_FIVE), "price"), path)
    wanted = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DoubleType())])
    return neat(housing.read_csv(spark, path, wanted), 2)


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, d):
    return table(spark, d, "customer").drop("c_name", "c_mktsegment")


@query("numeric_columns", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def numeric_only(spark, d):
    s = table(spark, d, "supplier")
    return s.select(*numeric_columns(s))


@query("cast_double", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def cast_double(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", *[F.col(c).cast("double").alias(c) for c in ("p_size", "p_retailprice")])


@query("derived_features", f"""
WITH l AS (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax END AS tax0 FROM lineitem)
SELECT l_orderkey, l_linenumber,
       {r('l_quantity + l_discount + tax0')} AS total,
       {r('l_quantity + 0.5 * l_discount + 0.5 * l_linenumber')} AS weighted,
       CAST(year(o_orderdate) - 1990 AS INTEGER) AS age,
       CAST(year(l_shipdate) - year(o_orderdate) AS INTEGER) AS lag_years,
       CAST(coalesce(year(l_shipdate) <> year(o_orderdate), true) AS INTEGER) AS shipped_later,
       CAST(coalesce(tax0 > 0, false) AS INTEGER) AS has_tax,
       {r('l_quantity * l_discount')} AS score
FROM l JOIN orders ON l_orderkey = o_orderkey""")
def derived_features(spark, d):
    """Sums, weighted sums, year differences, flags and products in one projection."""
    li = table(spark, d, "lineitem").withColumn("tax0", F.when(F.col("l_linenumber") != 7, F.col("l_tax")))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    both = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    ordered, shipped = F.year("o_orderdate"), F.year("l_shipdate")
    return neat(both.select(
        "l_orderkey", "l_linenumber",
        weighted_sum({"l_quantity": 1, "l_discount": 1, "tax0": 1}).alias("total"),
        weighted_sum({"l_quantity": 1, "l_discount": 0.5, "l_linenumber": 0.5}).alias("weighted"),
        (ordered - 1990).alias("age"),
        (shipped - ordered).alias("lag_years"),
        differs(shipped, ordered).alias("shipped_later"),
        present(F.col("tax0")).alias("has_tax"),
        (F.col("l_quantity") * F.col("l_discount")).alias("score"),
    ))


@query("outlier_filter", f"SELECT event_id, value FROM ({GAPPY_SQL}) WHERE value IS NULL OR value <= 150")
def outlier_filter(spark, d):
    return rows.remove_above(gappy_events(spark, d), "value", 150).select("event_id", "value")


@query("outlier_report", """
SELECT l_quantity, l_extendedprice, l_returnflag, l_linestatus FROM lineitem
WHERE l_quantity > 45 AND l_extendedprice < 5000""")
def outlier_report(spark, d):
    big, cheap = F.col("l_quantity") > 45, F.col("l_extendedprice") < 5000
    shown = ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
    return rows.suspicious(table(spark, d, "lineitem"), [big, cheap], shown)


IN_TRAIN = f"{FOLD_SQL.format(key='o_orderkey')} <> 0"


@query("train_test_union", f"""
SELECT 'train' AS split, o_orderkey, o_orderpriority, {r('ln(1 + o_totalprice)')} AS y FROM orders WHERE {IN_TRAIN}
UNION ALL SELECT 'test', o_orderkey, o_orderpriority, NULL FROM orders WHERE NOT ({IN_TRAIN})""")
def train_test_union(spark, d):
    o = table(spark, d, "orders")
    fold = fold_of(F.col("o_orderkey"))
    train = o.where(fold != 0).select("o_orderkey", "o_orderpriority", F.log1p("o_totalprice").alias("y"))
    test = o.where(fold == 0).select("o_orderkey", "o_orderpriority")
    return neat(rows.union_split(train, test).select("split", "o_orderkey", "o_orderpriority", "y"))


@query("split_back", f"SELECT o_orderkey, o_totalprice FROM orders WHERE NOT ({IN_TRAIN})")
def split_back(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    fold = fold_of(F.col("o_orderkey"))
    both = rows.union_split(o.where(fold != 0), o.where(fold == 0))
    return rows.take_split(both, "test")


@query("keyed_predictions", f"""
SELECT o_orderkey, o_totalprice, {r('ln(1 + c_acctbal + 1000)')} AS pred FROM orders JOIN customer ON o_custkey = c_custkey""")
def keyed_predictions(spark, d):
    """Predictions meet their rows by key, never by position."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.log1p(F.col("c_acctbal") + 1000).alias("pred"))
    return neat(o.join(c, "o_custkey").select("o_orderkey", "o_totalprice", "pred"))


@query("keys_removed", """
SELECT c_custkey, c_acctbal FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)""")
def keys_removed(spark, d):
    big = table(spark, d, "orders").where(F.col("o_totalprice") > 490000).select(F.col("o_custkey").alias("c_custkey"))
    return rows.drop_keys(table(spark, d, "customer").select("c_custkey", "c_acctbal"), big, ["c_custkey"])


@query("running_best", """
SELECT event_type AS study, event_id AS trial, value,
       min(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best
FROM events""")
def running_best(spark, d):
    e = table(spark, d, "events").select(
        F.col("event_type").alias("study"), F.col("event_id").alias("trial"), "value"
    )
    return rows.running_best(e, "study", "trial", "value")


@query("arg_max_row", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""")
def arg_max_row(spark, d):
    return rows.arg_max(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("fold_assign", f"SELECT c_custkey, CAST({FOLD_SQL.format(key='c_custkey')} AS INTEGER) AS fold FROM customer")
def fold_assign(spark, d):
    return table(spark, d, "customer").select("c_custkey", fold_of(F.col("c_custkey")).alias("fold"))


@query("table_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(spark, d):
    return profile.shape(table(spark, d, "lineitem"))
