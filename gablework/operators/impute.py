"""Missing values: constants, group medians, group and global modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.operators.profile import top_value, value_counts
from gablework.operators.quantile import group_medians
from gablework.shared import col, lookup_join, quoted


def fill_constant(df: DataFrame, columns: Sequence[str], value: str | float) -> DataFrame:
    """Constant for missing values; text goes into text columns, numbers into numeric ones."""
    return df.fillna(value, subset=list(columns))


def group_modes(df: DataFrame, value: str, by: Sequence[str], name: str = "mode") -> DataFrame:
    """(by..., mode): most frequent present value per group, the smallest on ties.

    Counted per (group, value) first, so a hot group never sits in one task. A
    group without any value has no row.
    """
    counts = df.where(col(value).isNotNull()).groupBy(*map(quoted, by), col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.groupBy(*map(quoted, by)).agg(top_value().alias(name))


def global_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """{column: most frequent text value}, the smallest on ties; ``None`` for an empty column."""
    found = value_counts(df, columns).groupBy("column").agg(top_value().alias("mode")).collect()
    modes = {r["column"]: r["mode"] for r in found}
    return {c: modes.get(c) for c in columns}


def fill_from_groups(
    df: DataFrame, value: str, by: Sequence[str], stats: DataFrame, name: str, null_key: str = "keep"
) -> DataFrame:
    """Fill ``value`` from the group's statistic; a column filled from a double becomes double.

    ``null_key='keep'`` treats a missing group key as one more group.
    ``null_key='pandas'`` blanks the value of such rows, present ones included,
    as a grouped transform in pandas does.
    """
    if null_key not in ("keep", "pandas"):
        raise ValueError("null_key is 'keep' or 'pandas'")
    joined = lookup_join(df, stats.withColumnRenamed(name, "__stat"), by)
    stat_type = stats.schema[name].dataType
    kind = stat_type if isinstance(stat_type, T.DoubleType) else df.schema[value].dataType  # a median of integers may lie between two
    filled = F.coalesce(col(value).cast(kind), F.col("__stat").cast(kind))
    if null_key == "pandas":
        for b in by:
            filled = F.when(col(b).isNotNull(), filled)
    return joined.withColumn(value, filled).select(*map(quoted, df.columns))


def fill_group_median(df: DataFrame, value: str, by: Sequence[str], null_key: str = "keep") -> DataFrame:
    return fill_from_groups(df, value, by, group_medians(df, value, by), "median", null_key)


def fill_group_mode(df: DataFrame, value: str, by: Sequence[str], null_key: str = "keep") -> DataFrame:
    return fill_from_groups(df, value, by, group_modes(df, value, by), "mode", null_key)


def fill_global_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass for all columns; text columns only."""
    modes = {c: m for c, m in global_modes(df, columns).items() if m is not None}
    return df.fillna(modes) if modes else df
