"""Data behind the plots: histograms, 2-D densities, quantile-quantile points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.functions import guarded_corr, normal_quantile
from gablework.operators.profile import per_column
from gablework.operators.quantile import quantiles
from gablework.shared import col, local_frame


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (min, max)} of the columns that hold a value: one row per column on the driver."""
    stats = {c: {"lo": F.min(x), "hi": F.max(x)} for c in columns for x in [col(c).cast("double")]}
    return {r["column"]: (r["lo"], r["hi"]) for r in per_column(df, stats).collect() if r["lo"] is not None}


def bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin; the last bin is closed, a single value falls into bin 0."""
    width = F.nullif((hi - lo) / bins, F.lit(0.0))
    raw = F.coalesce(F.floor((x.cast("double") - lo) / width), F.lit(0))
    return F.when(x.isNotNull(), F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """(column, bin, lo, hi, count) for every bin, empty ones included; missing values are dropped."""
    ranges = value_ranges(df, columns)
    spark = df.sparkSession
    edges = local_frame(
        spark, [(c, float(lo), float(hi)) for c, (lo, hi) in ranges.items()], "column string, lo0 double, hi0 double"
    )
    width = (F.col("hi0") - F.col("lo0")) / bins
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        "column", "bin",
        (F.col("lo0") + F.col("bin") * width).alias("lo"),
        (F.col("lo0") + (F.col("bin") + 1) * width).alias("hi"),
    )
    if not ranges:
        return frame.withColumn("count", F.lit(0).cast("long"))
    placed = F.array(
        *[
            F.struct(F.lit(c).alias("column"), bin_of(col(c), F.lit(lo), F.lit(hi), bins).alias("bin"))
            for c, (lo, hi) in ranges.items()
        ]
    )
    counts = (
        df.select(F.inline(placed)).where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(
            F.count(F.lit(1)).alias("count")
        )
    )
    return frame.join(F.broadcast(counts), ["column", "bin"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("long"))
    )


def density_2d(df: DataFrame, x: str, y: str, bins: int = 40) -> DataFrame:
    """(x_bin, y_bin, count): what a scatter plot of any number of rows shows."""
    ranges = value_ranges(df, [x, y])
    placed = [
        bin_of(col(c), F.lit(ranges[c][0]), F.lit(ranges[c][1]), bins).alias(n)
        if c in ranges else F.lit(None).cast("int").alias(n)
        for c, n in ((x, "x_bin"), (y, "y_bin"))
    ]
    both = df.select(*placed).where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return both.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


def density_panels(df: DataFrame, columns: Sequence[str], target: str, bins: int = 40) -> DataFrame:
    """(column, x_bin, y_bin, count): one panel per column against the target, from one scan."""
    ranges = value_ranges(df, [*columns, target])
    shown = [c for c in columns if c in ranges]
    if target not in ranges or not shown:
        return local_frame(df.sparkSession, [], "column string, x_bin int, y_bin int, count long")
    y = bin_of(col(target), *map(F.lit, ranges[target]), bins)
    panels = [F.struct(F.lit(c).alias("column"), bin_of(col(c), *map(F.lit, ranges[c]), bins).alias("x_bin")) for c in shown]
    placed = df.select(y.alias("y_bin"), F.inline(F.array(*panels))).where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return placed.groupBy("column", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


def plotting_positions(k: int) -> list[float]:
    """Filliben's estimate of the uniform order-statistic medians."""
    last = 0.5 ** (1.0 / k)
    return [1 - last, *[(i - 0.3175) / (k + 0.365) for i in range(2, k)], last]


def qq_points(df: DataFrame, column: str, k: int = 200) -> DataFrame:
    """(point, theoretical, sample): ``k`` sample quantiles against the normal ones."""
    probs = plotting_positions(k)
    theory = F.array(*[F.lit(normal_quantile(p)) for p in probs])
    q = quantiles(df, [column], probs)
    return q.select(F.posexplode(F.arrays_zip(theory.alias("t"), F.col("quantiles").alias("s")))).select(
        F.col("pos").alias("point"), F.col("col.t").alias("theoretical"), F.col("col.s").alias("sample")
    )


def qq_fit(points: DataFrame) -> DataFrame:
    """(slope, intercept, r) of the straight line through the points."""
    return points.agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        guarded_corr(F.col("theoretical"), F.col("sample")).alias("r"),
    )
