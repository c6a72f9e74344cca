"""Profiles of a table: shape, types, counts, moments, quantiles, correlation.

Every statistic of every column comes from one aggregate, unfolded afterwards
into one row per column; quantiles come from ``operators.quantile``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.functions import adjusted_skew, guarded_corr
from gablework.operators.gram import correlations
from gablework.operators.quantile import group_medians, quantiles
from gablework.shared import col, lookup_join, numeric_columns, quoted, string_columns


def per_column(df: DataFrame, stats: Mapping[str, Mapping[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    """One aggregate, one output row per column: ``{column: {stat: expression}}``."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), *[e.alias(s) for s, e in exprs.items()]) for c, exprs in stats.items()]
    )
    return df.groupBy(*[col(c) for c in by]).agg(rows.alias("__rows")).select(*[col(c) for c in by], F.inline("__rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) for every column."""
    return per_column(
        df,
        {f.name: {"dtype": F.lit(f.dataType.simpleString()), "non_null": F.count(col(f.name))} for f in df.schema},
    )


def column_kinds(df: DataFrame) -> DataFrame:
    """(kind, columns): how many numeric and how many text columns; from the schema alone."""
    counts = [("numeric", len(numeric_columns(df))), ("text", len(string_columns(df)))]
    return df.sparkSession.createDataFrame(counts, "kind string, columns int")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, q25, median, q75, max); std is the sample one."""
    columns = list(columns or numeric_columns(df))
    moments = per_column(
        df,
        {
            c: {
                "count": F.count(x),
                "mean": F.avg(x),
                "std": F.stddev_samp(x),
                "min": F.min(x),
                "max": F.max(x),
            }
            for c in columns
            for x in [col(c).cast("double")]
        },
    )
    q = quantiles(df, columns, [0.25, 0.5, 0.75])
    return moments.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min",
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))],
        "max",
    )


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n) of present text values; a hot value is combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
    long = df.select(*[col(c) for c in by], F.inline(pairs)).where(F.col("value").isNotNull())
    return long.groupBy(*[col(c) for c in by], "column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_value() -> Column:
    """The most frequent ``value`` of a counted frame; the smallest on ties."""
    return F.min_by("value", F.struct(-F.col("n"), F.col("value")))


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, unique, top, freq) of text columns; ``top`` is the smallest on ties."""
    columns = list(columns or string_columns(df))
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            top_value().alias("top"),
            F.max("n").alias("freq"),
        )
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, rows) of every column."""
    columns = list(columns or df.columns)
    return per_column(
        df, {c: {"missing": F.count_if(col(c).isNull()), "rows": F.count(F.lit(1))} for c in columns}
    )


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, percent) of the columns with gaps, the emptiest first."""
    return (
        null_counts(df, columns)
        .where(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") / F.col("rows") * 100).alias("percent"))
        .orderBy(F.desc("percent"), "column")
    )


def columns_with_nulls(df: DataFrame) -> list[str]:
    return [r["column"] for r in null_counts(df).where(F.col("missing") > 0).collect()]


def assert_no_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    left = {r["column"]: r["missing"] for r in null_counts(df, columns).where(F.col("missing") > 0).collect()}
    if left:
        raise ValueError(f"missing values remain: {left}")


def skewness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, skew): bias-adjusted, missing skipped, the most skewed first."""
    columns = list(columns or numeric_columns(df))
    return per_column(df, {c: {"skew": adjusted_skew(col(c))} for c in columns}).orderBy(
        F.desc_nulls_last("skew"), "column"
    )


def max_skew(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, skew) of the most skewed column."""
    return skewness(df, columns).limit(1)


def corr_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, r, abs_r) of each column with the target, the strongest first."""
    found = per_column(df, {c: {"r": guarded_corr(col(c), col(target))} for c in columns})
    return found.withColumn("abs_r", F.abs("r")).orderBy(F.desc_nulls_last("abs_r"), "column")


def top_correlated(df: DataFrame, columns: Sequence[str], target: str, k: int = 15) -> DataFrame:
    return corr_with(df, columns, target).limit(k)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) of every pair, both orders and the diagonal, from one pass of cross-product sums."""
    return correlations(df, columns)


def group_median_order(df: DataFrame, by: str, target: str) -> DataFrame:
    """(by, median) of the target per category, the highest median first."""
    known = df.where(col(by).isNotNull())
    return group_medians(known, target, [by]).orderBy(F.desc_nulls_last("median"), by)


def box_bounds(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., q1, median, q3, low, high): quartiles and the fences 1.5 IQR beyond them."""
    q = quantiles(df, [value], [0.25, 0.5, 0.75], by=by)
    q1, q2, q3 = (F.col("quantiles")[i] for i in range(3))
    return q.select(
        *[col(c) for c in by], q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("low"), (q3 + 1.5 * (q3 - q1)).alias("high"),
    )


def _with_bounds(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    if by:
        return lookup_join(df, box_bounds(df, value, by), by, "inner")
    b = box_bounds(df, value).first()
    limits = b.asDict() if b else dict.fromkeys(("q1", "median", "q3", "low", "high"))
    return df.withColumns({k: F.lit(v).cast("double") for k, v in limits.items()})


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., q1, median, q3, whisker_low, whisker_high, outliers) as a box plot draws them.

    Whiskers end at the last value inside the fences, and never inside the box.
    """
    x = col(value).cast("double")
    inside = x.between(F.col("low"), F.col("high"))
    stats = _with_bounds(df.select(*[col(c) for c in by], col(value)), value, by).where(x.isNotNull())
    return stats.groupBy(*[col(c) for c in by]).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.least(F.min(F.when(inside, x)), F.first("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, x)), F.first("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows outside the fences."""
    x = col(value).cast("double")
    kept = _with_bounds(df, value, by).where((x < F.col("low")) | (x > F.col("high")))
    return kept.select(*map(quoted, df.columns))


def panel_rows(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(panel, category, target): the target beside the category of each column, from one scan; missing categories are left out."""
    pairs = [F.struct(F.lit(c).alias("panel"), col(c).cast("string").alias("category")) for c in columns]
    return df.select(col(target).cast("double").alias("target"), F.inline(F.array(*pairs))).where(F.col("category").isNotNull())


def box_panels(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``box_stats`` of the target by the categories of several columns: (column, category, q1, median, ...)."""
    return box_stats(panel_rows(df, columns, target), "target", ["panel", "category"]).withColumnRenamed("panel", "column")


def median_panels(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, category, median, place): each column's categories, the highest median first."""
    found = group_medians(panel_rows(df, columns, target), "target", ["panel", "category"]).withColumnRenamed("panel", "column")
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc_nulls_last("median"), "category"))  # categories, not rows
    return found.withColumn("place", place)
