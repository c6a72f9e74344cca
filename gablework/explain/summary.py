"""Tables made from attributions: long form, global summary, one row's breakdown, dependence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.functions import price_error
from gablework.operators.binning import bin_of, value_ranges
from gablework.operators.profile import corr_with, per_column
from gablework.operators.quantile import quantiles
from gablework.operators.rows import arg_max
from gablework.shared import col, local_frame, materialize


def to_long(attributions: DataFrame, features: Sequence[str], key: str, values: bool = False) -> DataFrame:
    """(key, feature, [feature_value,] shap): one row per explained row and feature.

    ``values=True`` needs the feature columns beside the contributions.
    """
    items = []
    for i, c in enumerate(features):
        parts = [F.lit(c).alias("feature"), F.col("contributions")[i].alias("shap")]
        if values:
            parts.insert(1, col(c).cast("double").alias("feature_value"))
        items.append(F.struct(*parts))
    return attributions.select(col(key), F.inline(F.array(*items)))


def global_importance(attributions: DataFrame, features: Sequence[str], k: int | None = None) -> DataFrame:
    """(feature, shap_importance): mean absolute contribution, the largest first; one aggregate for all features."""
    stats = {c: {"shap_importance": F.avg(F.abs(F.col("contributions")[i]))} for i, c in enumerate(features)}
    ranked = per_column(attributions, stats).withColumnRenamed("column", "feature")
    ranked = ranked.orderBy(F.desc("shap_importance"), "feature")
    return ranked if k is None else ranked.limit(k)


def contribution_deciles(long: DataFrame) -> DataFrame:
    """(feature, quantiles): deciles of the contributions, the spread a summary plot shows."""
    q = quantiles(long, ["shap"], [i / 10 for i in range(11)], by=["feature"])
    return q.select("feature", "quantiles")


def row_breakdowns(attributions: DataFrame, features: Sequence[str], key: str, k: int = 15) -> DataFrame:
    """(key, rank, feature, shap): per explained row the k contributions largest in
    absolute value, and the sum of all others as one more. Sorted inside the row:
    nothing is shuffled."""
    items = F.array(
        *[F.struct((-F.abs(F.col("contributions")[i])).alias("order"), F.lit(c).alias("feature"),
                   F.col("contributions")[i].alias("shap")) for i, c in enumerate(features)]
    )
    ranked = F.transform(
        F.slice(F.array_sort(items), 1, k),
        lambda x, i: F.struct((i + 1).alias("rank"), x["feature"].alias("feature"), x["shap"].alias("shap")),
    )
    if len(features) > k:
        others = F.slice(F.array_sort(items), k + 1, len(features))
        total = F.aggregate(others, F.lit(0.0), lambda acc, x: acc + x["shap"])
        rest = F.struct(F.lit(k + 1).alias("rank"), F.lit("other").alias("feature"), total.alias("shap"))
        ranked = F.concat(ranked, F.array(rest))
    return attributions.select(col(key), F.inline(ranked))


def breakdown(attributions: DataFrame, features: Sequence[str], key: str, y: str, k: int = 15) -> DataFrame:
    """(rank, feature, shap) of the row with the largest ``y``: base, the k
    largest contributions, all others in one, and their total."""
    row = materialize(arg_max(attributions, y, key), "row")
    top = row_breakdowns(row, features, key, k).select("rank", "feature", "shap")
    base = row.select(F.lit(0).alias("rank"), F.lit("base").alias("feature"), F.col("base").alias("shap"))
    everything = F.aggregate("contributions", F.lit(0.0), lambda acc, v: acc + v)
    total = row.select(
        F.lit(k + 2).alias("rank"), F.lit("total").alias("feature"), (F.col("base") + everything).alias("shap")
    )
    return base.unionByName(top).unionByName(total).orderBy("rank")


def dependence(attributions: DataFrame, features: Sequence[str], feature: str, bins: int = 20) -> DataFrame:
    """(bin, lo, hi, count, mean_shap): contribution of a feature along its own value."""
    ranges = value_ranges(attributions, [feature])
    if not ranges:
        return local_frame(
            attributions.sparkSession, [], "bin int, lo double, hi double, count long, mean_shap double"
        )
    lo, hi = ranges[feature]
    width = (hi - lo) / bins
    shap = F.col("contributions")[list(features).index(feature)]
    binned = attributions.select(bin_of(col(feature), F.lit(lo), F.lit(hi), bins).alias("bin"), shap.alias("shap"))
    counted = binned.where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"), F.avg("shap").alias("mean_shap")
    )
    left = F.lit(lo) + F.col("bin") * F.lit(width)
    return counted.select("bin", left.alias("lo"), (left + F.lit(width)).alias("hi"), "count", "mean_shap")


def interaction_partner(attributions: DataFrame, features: Sequence[str], feature: str, bins: int = 20) -> DataFrame:
    """(column, r, abs_r) of the other features with what the feature's own value leaves
    unexplained of its contribution; the first row is the colour of a dependence plot."""
    means = dependence(attributions, features, feature, bins).select("bin", "mean_shap")
    lo, hi = value_ranges(attributions, [feature])[feature]
    shap = F.col("contributions")[list(features).index(feature)]
    placed = attributions.withColumn("bin", bin_of(col(feature), F.lit(lo), F.lit(hi), bins))
    # at most one row per bin
    residual = placed.join(F.broadcast(means), "bin").withColumn("__residual", shap - F.col("mean_shap"))
    return corr_with(residual, [c for c in features if c != feature], "__residual")


def coloured_dependence(attributions: DataFrame, features: Sequence[str], feature: str, bins: int = 20) -> DataFrame:
    """(bin, lo, hi, count, mean_shap, colour, mean_colour): the dependence of a feature, coloured by its interaction partner."""
    partner = interaction_partner(attributions, features, feature, bins).first()["column"]
    plain = dependence(attributions, features, feature, bins)
    lo, hi = value_ranges(attributions, [feature])[feature]
    placed = attributions.select(bin_of(col(feature), F.lit(lo), F.lit(hi), bins).alias("bin"), col(partner).cast("double").alias("v"))
    means = placed.where("bin IS NOT NULL").groupBy("bin").agg(F.avg("v").alias("mean_colour"))
    return plain.join(F.broadcast(means), "bin").withColumn("colour", F.lit(partner))  # at most one row per bin


def compare_importance(shap: DataFrame, builtin: DataFrame, k: int = 15) -> DataFrame:
    """(feature, shap_importance, shap_rank, importance, builtin_rank): the k first of either, side by side.

    Both tables have one row per feature.
    """
    def ranked(df: DataFrame, value: str, name: str) -> DataFrame:
        w = Window.orderBy(F.desc(value), "feature")
        return df.select("feature", value, F.row_number().over(w).alias(name)).where(F.col(name) <= k)

    both = ranked(shap, "shap_importance", "shap_rank").join(
        ranked(builtin, "importance", "builtin_rank"), "feature", "full"
    )
    return both.orderBy(F.asc_nulls_last("shap_rank"), F.asc_nulls_last("builtin_rank"))


def prediction_error(df: DataFrame, key: str, y: str, predicted: str) -> DataFrame:
    """(key, actual, predicted, error) in original units."""
    return df.select(
        col(key),
        F.expm1(col(y)).alias("actual"),
        F.expm1(col(predicted)).alias("predicted"),
        price_error(col(y), col(predicted)).alias("error"),
    )
