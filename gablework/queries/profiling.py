"""Profiles and the data behind plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablework.functions import normal_quantile
from gablework.operators import binning, profile
from gablework.queries.inputs import GAPPY_SQL, gappy_events
from gablework.queries.registry import neat, query, r, table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def each(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


GAPPY_COLUMNS = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double"}


@query("column_info", f"WITH g AS ({GAPPY_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM g" for c, t in GAPPY_COLUMNS.items()))
def column_info(spark, d):
    return profile.info(gappy_events(spark, d))


@query("describe_numeric", each(LINE_NUMBERS, f"""
SELECT '{{c}}' AS "column", count({{c}}) AS count, {r('avg({c})', 4)} AS mean, {r('stddev_samp({c})', 4)} AS std, min({{c}}) AS min,
  {r('quantile_cont({c}, 0.25)', 4)} AS q25, {r('quantile_cont({c}, 0.5)', 4)} AS median, {r('quantile_cont({c}, 0.75)', 4)} AS q75,
  max({{c}}) AS max FROM lineitem"""))
def describe_numeric(spark, d):
    return neat(profile.describe_numeric(table(spark, d, "lineitem"), LINE_NUMBERS), 4)


@query("describe_categorical", each(["c_name", "c_mktsegment"], """
SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  first({c} ORDER BY n DESC, {c}) AS top, max(n) AS freq
FROM (SELECT {c}, count(*) AS n FROM customer GROUP BY {c})"""))
def describe_categorical(spark, d):
    return profile.describe_categorical(table(spark, d, "customer"))


@query("missing_report", f"WITH g AS ({GAPPY_SQL}) SELECT * FROM (" + each(GAPPY_COLUMNS, f"""
SELECT '{{c}}' AS "column", count(*) - count({{c}}) AS missing, {r('(count(*) - count({c})) * 100.0 / count(*)')} AS percent FROM g""")
       + ") WHERE missing > 0")
def missing_report(spark, d):
    return neat(profile.missing_report(gappy_events(spark, d)))


@query("columns_with_nulls", f"WITH g AS ({GAPPY_SQL}) SELECT \"column\", missing FROM (" + each(
    GAPPY_COLUMNS,
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM g") + ") WHERE missing > 0")
def columns_with_nulls(spark, d):
    return profile.null_counts(gappy_events(spark, d)).where(F.col("missing") > 0).select("column", "missing")


@query("skew_adjusted", f"WITH g AS ({GAPPY_SQL}) " + each(["event_id", "user_id", "value"],
       f"SELECT '{{c}}' AS \"column\", {r('skewness({c})')} AS skew FROM g"))
def skew_adjusted(spark, d):
    return neat(profile.skewness(gappy_events(spark, d)))


@query("corr_target", "SELECT *, abs(r) AS abs_r FROM (" + each(["l_quantity", "l_discount", "l_tax", "l_linenumber"],
       f"SELECT '{{c}}' AS \"column\", {r('corr({c}, l_extendedprice)')} AS r FROM lineitem") + ")")
def corr_target(spark, d):
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    return neat(profile.corr_with(table(spark, d, "lineitem"), cols, "l_extendedprice"))


@query("top_correlated", """
WITH o AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q, avg(l_discount) AS disc, sum(l_extendedprice) AS rev
           FROM lineitem GROUP BY l_orderkey)
SELECT *, abs(r) AS abs_r FROM (""" + each(["n", "q", "disc"], f"SELECT '{{c}}' AS \"column\", {r('corr({c}, rev)')} AS r FROM o")
       + ") ORDER BY abs_r DESC LIMIT 2")
def top_correlated(spark, d):
    o = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("disc"),
        F.sum("l_extendedprice").alias("rev"),
    )
    return neat(profile.top_correlated(o, ["n", "q", "disc"], "rev", 2))


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM lineitem" for a in LINE_NUMBERS for b in LINE_NUMBERS))
def corr_matrix(spark, d):
    return neat(profile.corr_matrix(table(spark, d, "lineitem"), LINE_NUMBERS))


@query("group_median_order", f"""
SELECT p_brand, {r('median(l_extendedprice)', 4)} AS median FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def group_median_order(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sold = table(spark, d, "lineitem").select("l_partkey", "l_extendedprice").join(part, "l_partkey")
    return neat(profile.group_median_order(sold, "p_brand", "l_extendedprice"), 4)


BOX_SQL = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY event_type),
     e AS (SELECT e.*, q1, m, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
           FROM events e JOIN q USING (event_type))
"""


@query("box_stats", BOX_SQL + f"""
SELECT event_type, {r('any_value(q1)')} AS q1, {r('any_value(m)')} AS median, {r('any_value(q3)')} AS q3,
  {r('least(min(value) FILTER (inside), any_value(q1))')} AS whisker_low,
  {r('greatest(max(value) FILTER (inside), any_value(q3))')} AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM e GROUP BY event_type""")
def box_stats(spark, d):
    return neat(profile.box_stats(table(spark, d, "events"), "value", ["event_type"]))


@query("box_outliers", BOX_SQL + "SELECT event_id, event_type, value FROM e WHERE NOT inside")
def box_outliers(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    return profile.box_outliers(e, "value", ["event_type"])


@query("histogram", f"""
WITH g AS ({GAPPY_SQL}), v AS (SELECT min(value) AS lo, max(value) AS hi FROM g),
     c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
           FROM g, v WHERE value IS NOT NULL GROUP BY 1)
SELECT 'value' AS "column", CAST(b.bin AS INTEGER) AS bin, {r('lo + b.bin * ((hi - lo) / 50)')} AS lo,
       {r('lo + (b.bin + 1) * ((hi - lo) / 50)')} AS hi, coalesce(n, 0) AS count
FROM range(50) b(bin) CROSS JOIN v LEFT JOIN c ON c.bin = b.bin""")
def histogram(spark, d):
    return neat(binning.histogram(gappy_events(spark, d), ["value"], 50))


@query("density_2d", """
WITH v AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)
SELECT CAST(least(floor((l_quantity - x0) / ((x1 - x0) / 40)), 39) AS INTEGER) AS x_bin,
       CAST(least(floor((l_extendedprice - y0) / ((y1 - y0) / 40)), 39) AS INTEGER) AS y_bin, count(*) AS count
FROM lineitem, v GROUP BY 1, 2""")
def density_2d(spark, d):
    return binning.density_2d(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 40)


QQ_POINTS = 50
QQ_SQL = "SELECT point, CAST(theoretical AS DOUBLE) AS theoretical, sample FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS point, {normal_quantile(p)!r} AS theoretical, quantile_cont(ln(1 + o_totalprice), {p!r}) AS sample FROM orders"
    for i, p in enumerate(binning.plotting_positions(QQ_POINTS))
) + ")"


@query("qq_points", f"SELECT point, {r('theoretical')} AS theoretical, {r('sample')} AS sample FROM ({QQ_SQL})")
def qq_points(spark, d):
    y = table(spark, d, "orders").select(F.log1p("o_totalprice").alias("y"))
    return neat(binning.qq_points(y, "y", QQ_POINTS))


@query("qq_fit", f"""
SELECT {r('regr_slope(sample, theoretical)')} AS slope, {r('regr_intercept(sample, theoretical)')} AS intercept,
       {r('corr(sample, theoretical)')} AS r FROM ({QQ_SQL})""")
def qq_fit(spark, d):
    y = table(spark, d, "orders").select(F.log1p("o_totalprice").alias("y"))
    return neat(binning.qq_fit(binning.qq_points(y, "y", QQ_POINTS)))


PANELS = ["l_quantity", "l_discount", "l_tax"]


@query("density_panels", """WITH v AS (SELECT min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)""" + "".join(
    f", {c}_v AS (SELECT min({c}) AS x0, max({c}) AS x1 FROM lineitem)" for c in PANELS) + " " + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(least(floor(({c} - x0) / ((x1 - x0) / 40)), 39) AS INTEGER) AS x_bin,
  CAST(least(floor((l_extendedprice - y0) / ((y1 - y0) / 40)), 39) AS INTEGER) AS y_bin, count(*) AS count FROM lineitem, v, {c}_v GROUP BY 2, 3""" for c in PANELS))
def density_panels(spark, d):
    """Scatter panels of several columns against one target, from one scan."""
    return binning.density_panels(table(spark, d, "lineitem"), PANELS, "l_extendedprice", 40)


GROUPS = ["o_orderstatus", "o_orderpriority"]
PANEL_ROWS = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c} AS category, o_totalprice AS v FROM orders""" for c in GROUPS)


@query("box_panels", f"""WITH p AS ({PANEL_ROWS}),
q AS (SELECT "column", category, quantile_cont(v, 0.25) AS q1, median(v) AS m, quantile_cont(v, 0.75) AS q3 FROM p GROUP BY 1, 2),
e AS (SELECT p.*, q1, m, q3, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM p JOIN q USING ("column", category))
SELECT "column", category, {r('any_value(q1)')} AS q1, {r('any_value(m)')} AS median, {r('any_value(q3)')} AS q3,
  {r('least(min(v) FILTER (inside), any_value(q1))')} AS whisker_low, {r('greatest(max(v) FILTER (inside), any_value(q3))')} AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM e GROUP BY 1, 2""")
def box_panels(spark, d):
    return neat(profile.box_panels(table(spark, d, "orders"), GROUPS, "o_totalprice"))


@query("median_panels", f"""SELECT "column", category, {r('median')} AS median,
  CAST(row_number() OVER (PARTITION BY "column" ORDER BY median DESC, category) AS INTEGER) AS place
FROM (SELECT "column", category, median(v) AS median FROM ({PANEL_ROWS}) GROUP BY 1, 2)""")
def median_panels(spark, d):
    return neat(profile.median_panels(table(spark, d, "orders"), GROUPS, "o_totalprice"))


WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"]
WIDE_PAIRS = [(f"{c}_{n}", f"CASE WHEN l_orderkey % {n} = 0 THEN NULL ELSE {c} * CASE WHEN l_linenumber % {n} = 0 THEN 2 ELSE 1 END END") for c in WIDE for n in (3, 7)]


@query("corr_matrix_gaps", "WITH w AS (SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE_PAIRS) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM w" for a, _ in WIDE_PAIRS for b, _ in WIDE_PAIRS))
def corr_matrix_gaps(spark, d):
    """Sixteen columns with gaps, every pair over the rows that have both."""
    w = table(spark, d, "lineitem").select(*[F.expr(e).cast("double").alias(n) for n, e in WIDE_PAIRS])
    return neat(profile.corr_matrix(w, [n for n, _ in WIDE_PAIRS]))
