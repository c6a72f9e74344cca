"""Missing values, encoders, scalers, and the fitted plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablework.functions import fold_of
from gablework.operators import encode, impute, profile
from gablework.plans.prep import PrepPlan, PrepRecipe, prepare
from gablework.queries.inputs import FOLD_SQL, GAPPY_SQL, gappy_events
from gablework.queries.registry import neat, query, r, table
from gablework.shared import scratch_path

PRIORITY = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}


@query("fill_constants", f"SELECT event_id, coalesce(event_type, 'None') AS event_type, coalesce(value, 0) AS value FROM ({GAPPY_SQL})")
def fill_constants(spark, d):
    g = gappy_events(spark, d).drop("user_id")
    return impute.fill_constant(impute.fill_constant(g, ["event_type"], "None"), ["value"], 0)


@query("group_median_impute", f"""
WITH g AS ({GAPPY_SQL}), m AS (SELECT event_type, median(value) AS m FROM g GROUP BY event_type)
SELECT event_id, g.event_type, {r('coalesce(value, m)')} AS value
FROM g LEFT JOIN m ON g.event_type IS NOT DISTINCT FROM m.event_type""")
def group_median_impute(spark, d):
    return neat(impute.fill_group_median(gappy_events(spark, d), "value", ["event_type"]).drop("user_id"))


@query("group_median_impute_null_key", f"""
WITH g AS ({GAPPY_SQL}), m AS (SELECT event_type, median(value) AS m FROM g GROUP BY event_type)
SELECT event_id, g.event_type, CASE WHEN g.event_type IS NOT NULL THEN {r('coalesce(value, m)')} END AS value
FROM g LEFT JOIN m ON g.event_type = m.event_type""")
def group_median_impute_null_key(spark, d):
    """The stricter rule for rows without a group: their value is blanked."""
    filled = impute.fill_group_median(gappy_events(spark, d), "value", ["event_type"], null_key="pandas")
    return neat(filled.drop("user_id"))


@query("group_mode", """
SELECT CAST(y AS INTEGER) AS y, l_quantity AS mode FROM (
  SELECT y, l_quantity, row_number() OVER (PARTITION BY y ORDER BY n DESC, l_quantity) AS rn FROM (
    SELECT year(l_shipdate) AS y, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rn = 1""")
def group_mode(spark, d):
    li = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y"), "l_quantity")
    return impute.group_modes(li, "l_quantity", ["y"])


@query("group_mode_impute", f"""
WITH g AS ({GAPPY_SQL}),
     m AS (SELECT user_id, event_type AS m FROM (
             SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn
             FROM (SELECT user_id, event_type, count(*) AS n FROM g WHERE event_type IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1)
SELECT event_id, g.user_id, coalesce(event_type, m) AS event_type FROM g LEFT JOIN m ON g.user_id = m.user_id""")
def group_mode_impute(spark, d):
    return impute.fill_group_mode(gappy_events(spark, d), "event_type", ["user_id"]).drop("value")


GAPPY_ORDERS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders"""


def gappy_orders(spark, d):
    key = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(key % 6 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


def mode_sql(source: str, c: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("global_mode_impute", f"""
WITH g AS ({GAPPY_ORDERS}) SELECT o_orderkey, coalesce(o_orderpriority, {mode_sql('g', 'o_orderpriority')}) AS o_orderpriority,
  coalesce(o_orderstatus, {mode_sql('g', 'o_orderstatus')}) AS o_orderstatus FROM g""")
def global_mode_impute(spark, d):
    return impute.fill_global_mode(gappy_orders(spark, d), ["o_orderpriority", "o_orderstatus"])


@query("null_check", """
SELECT 'o_orderkey' AS "column", 0 AS missing, count(*) AS rows FROM orders UNION ALL
SELECT 'o_orderpriority', 0, count(*) FROM orders UNION ALL SELECT 'o_orderstatus', 0, count(*) FROM orders""")
def null_check(spark, d):
    filled = impute.fill_global_mode(gappy_orders(spark, d), ["o_orderpriority", "o_orderstatus"])
    profile.assert_no_nulls(filled)
    return profile.null_counts(filled)


@query("skew_log1p", f"""
WITH g AS ({GAPPY_SQL}), s AS (SELECT skewness(value) > 0.75 AS a, skewness(user_id) > 0.75 AS b FROM g)
SELECT event_id, {r('CASE WHEN b THEN ln(1 + user_id) ELSE user_id END')} AS user_id,
       {r('CASE WHEN a THEN ln(1 + value) ELSE value END')} AS value FROM g, s""")
def skew_log1p(spark, d):
    g = gappy_events(spark, d).drop("event_type")
    out = encode.fix_skewness(g, 0.75, ["user_id", "value"])
    return neat(out.select("event_id", F.col("user_id").cast("double"), "value"))


@query("max_skew_after", f"""
WITH g AS ({GAPPY_SQL}), l AS (SELECT event_id, user_id, ln(1 + value) AS value FROM g)
SELECT * FROM (SELECT 'event_id' AS "column", {r('skewness(event_id)')} AS skew FROM l UNION ALL
  SELECT 'user_id', {r('skewness(user_id)')} FROM l UNION ALL SELECT 'value', {r('skewness(value)')} FROM l)
ORDER BY skew DESC LIMIT 1""")
def max_skew_after(spark, d):
    return neat(profile.max_skew(encode.fix_skewness(gappy_events(spark, d).drop("event_type"))))


@query("ordinal_encode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 END
  AS o_orderpriority FROM orders""")
def ordinal_encode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return encode.ordinal_encode(o, ["o_orderpriority"], PRIORITY)


@query("label_encode", f"""
SELECT event_id, CAST(dense_rank() OVER (ORDER BY coalesce(event_type, 'nan')) - 1 AS INTEGER) AS event_type FROM ({GAPPY_SQL})""")
def label_encode(spark, d):
    return encode.label_encode(gappy_events(spark, d), ["event_type"]).select("event_id", "event_type")


@query("label_encode_wide", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name FROM customer""")
def label_encode_wide(spark, d):
    """As many classes as rows: the codes come from a sorted table instead of a list."""
    return encode.label_encode(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_name"], limit=100)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def one_hot(spark, d):
    return encode.one_hot(table(spark, d, "customer").select("c_custkey", "c_mktsegment"))


@query("robust_scale", f"""
WITH g AS ({GAPPY_SQL}), s AS (SELECT median(value) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS w,
  median(user_id) AS mu, quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25) AS wu FROM g)
SELECT event_id, {r('(value - m) / CASE WHEN w = 0 THEN 1 ELSE w END')} AS value,
       {r('(user_id - mu) / CASE WHEN wu = 0 THEN 1 ELSE wu END')} AS user_id FROM g, s""")
def robust_scale(spark, d):
    return neat(encode.robust_scale(gappy_events(spark, d).drop("event_type"), ["value", "user_id"]))


# One table that needs every step: gaps, a skewed column, quality texts, nominal texts.

RECIPE = PrepRecipe(
    key="o_orderkey", target="y", drop=["junk"],
    outlier_column="o_totalprice", outlier_threshold=490000,
    fill_text={"status": "None"}, fill_number={"bonus": 0.0},
    group_median={"bal": "c_mktsegment"}, group_mode={"priority": "c_nationkey"}, global_mode=["c_mktsegment2"],
    derive=[("total", "bal + bonus"), ("has_bonus", "int(coalesce(bonus > 0, false))")],
    ordinal={"priority": PRIORITY}, labels=["status"], one_hot=["c_mktsegment", "c_mktsegment2"],
)

RAW_SQL = f"""
raw AS (
  SELECT o_orderkey, o_totalprice, c_nationkey, c_mktsegment,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment2,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE exp(c_acctbal / 1500) END AS bonus,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    {FOLD_SQL.format(key='o_orderkey')} = 0 AS held
  FROM orders JOIN customer ON o_custkey = c_custkey),
kept AS (SELECT *, CASE WHEN held THEN 'test' ELSE 'train' END AS split, CASE WHEN NOT held THEN ln(1 + o_totalprice) END AS y
         FROM raw WHERE held OR o_totalprice <= 490000)"""

FILLED_SQL = f"""
gm AS (SELECT c_mktsegment, median(bal) AS m FROM kept GROUP BY 1),
pm AS (SELECT c_nationkey, priority AS m FROM (
         SELECT c_nationkey, priority, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, priority) AS rn
         FROM kept WHERE priority IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
filled AS (
  SELECT o_orderkey, split, y, o_totalprice, CAST(kept.c_nationkey AS DOUBLE) AS c_nationkey, kept.c_mktsegment,
    coalesce(c_mktsegment2, {mode_sql('kept', 'c_mktsegment2')}) AS c_mktsegment2, coalesce(bal, gm.m) AS bal,
    coalesce(bonus, 0) AS bonus, coalesce(status, 'None') AS status, coalesce(priority, pm.m) AS priority
  FROM kept JOIN gm ON kept.c_mktsegment = gm.c_mktsegment JOIN pm ON kept.c_nationkey = pm.c_nationkey),
sk AS (SELECT skewness(o_totalprice) > 0.75 AS s1, skewness(c_nationkey) > 0.75 AS s2, skewness(bal) > 0.75 AS s3,
       skewness(bonus) > 0.75 AS s4 FROM filled),
logged AS (
  SELECT o_orderkey, split, y, c_mktsegment, c_mktsegment2, status, priority,
    CASE WHEN s1 THEN ln(1 + o_totalprice) ELSE o_totalprice END AS o_totalprice,
    CASE WHEN s2 THEN ln(1 + c_nationkey) ELSE c_nationkey END AS c_nationkey,
    CASE WHEN s3 THEN ln(1 + bal) ELSE bal END AS bal, CASE WHEN s4 THEN ln(1 + bonus) ELSE bonus END AS bonus
  FROM filled, sk)"""

PREPARED_SQL = "SELECT o_orderkey, split, " + r("y") + " AS y, " + ", ".join(
    [f"{r(c, 4)} AS {c}" for c in ("o_totalprice", "c_nationkey", "bal", "bonus")]
) + f""", {r('bal + bonus', 4)} AS total, CAST(CAST(coalesce(bonus > 0, false) AS INTEGER) AS DOUBLE) AS has_bonus,
  CAST(CASE priority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 END AS DOUBLE) AS priority,
  CAST(dense_rank() OVER (ORDER BY status) - 1 AS DOUBLE) AS status, """ + ", ".join(
    f"CAST(CAST({c} = '{s}' AS INTEGER) AS DOUBLE) AS \"{c}_{s}\"" for c in ("c_mktsegment", "c_mktsegment2") for s in SEGMENTS
) + " FROM logged"


def raw_orders(spark, d):
    key = F.col("o_orderkey")
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal")
    return o.join(c, "o_custkey").select(
        key, "o_totalprice", "c_nationkey", "c_mktsegment",
        F.when(key % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment2"),
        F.when(key % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(key % 5 != 0, F.exp(F.col("c_acctbal") / 1500)).alias("bonus"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 6 != 0, F.col("o_orderpriority")).alias("priority"),
        F.lit("x").alias("junk"), (fold_of(key) == 0).alias("held"),
    )


def split_orders(spark, d):
    raw = raw_orders(spark, d)
    train = raw.where(~F.col("held")).drop("held").withColumn("y", F.log1p("o_totalprice"))
    return train, raw.where("held").drop("held")


@query("prep_plan", f"WITH {RAW_SQL}, {FILLED_SQL} {PREPARED_SQL}")
def prep_plan(spark, d):
    """Outliers, union, fill, log, derive, encode, cast: fitted once, applied as projections."""
    train, test = split_orders(spark, d)
    prepared, _ = prepare(train, test, RECIPE)
    return neat(prepared, 4, y=6)


@query("prep_plan_reloaded", f"WITH {RAW_SQL}, {FILLED_SQL} SELECT * FROM ({PREPARED_SQL}) WHERE split = 'test'")
def prep_plan_reloaded(spark, d):
    """A plan saved, loaded and applied to the test rows alone gives what it gave them in the union."""
    train, test = split_orders(spark, d)
    _, plan = prepare(train, test, RECIPE)
    path = scratch_path(spark, "plan")
    plan.save(spark, path)
    alone = test.withColumn("split", F.lit("test")).withColumn("y", F.lit(None).cast("double"))
    return neat(PrepPlan.load(spark, path).transform(alone), 4, y=6)


MANY = PrepRecipe(
    key="o_orderkey", target="y", group_median={"bal": "c_name"}, labels=["c_name"], one_hot=["c_mktsegment"], skew_threshold=None,
)


@query("prep_plan_many_groups", f"""
WITH raw AS (SELECT o_orderkey, o_totalprice, coalesce(c_name, 'nan') AS c_name, c_mktsegment, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS bal
  FROM orders JOIN customer ON o_custkey = c_custkey),
gm AS (SELECT c_name, median(bal) AS m FROM raw GROUP BY 1)
SELECT o_orderkey, {r('o_totalprice', 4)} AS o_totalprice, CAST(dense_rank() OVER (ORDER BY raw.c_name) - 1 AS DOUBLE) AS c_name, {r('coalesce(bal, m)', 4)} AS bal, """ + ", ".join(
    f"CAST(CAST(c_mktsegment = '{s}' AS INTEGER) AS DOUBLE) AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM raw JOIN gm ON raw.c_name = gm.c_name")
def prep_plan_many_groups(spark, d):
    """Group statistics and label codes beyond what a plan keeps as literals: tables beside it, saved and loaded with it."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = table(spark, d, "orders").join(c, "o_custkey").select(
        "o_orderkey", "o_totalprice", "c_name", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("bal"), "c_mktsegment",
    )
    plan = PrepPlan.fit(rows, MANY, literals=50, groups=50)
    path = scratch_path(spark, "plan")
    plan.save(spark, path)
    return neat(PrepPlan.load(spark, path).transform(rows), 4)
