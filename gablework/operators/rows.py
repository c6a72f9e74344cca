"""Row-level operators: outlier rules, union and split, ranking, running best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.shared import col, quoted, safe_join


def remove_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Drop rows whose value lies above the threshold; a missing value stays."""
    return df.where(F.coalesce(~(col(column) > threshold), F.lit(True)))


def suspicious(df: DataFrame, conditions: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The rows that meet all conditions, reduced to the reported columns."""
    for c in conditions:
        df = df.where(c)
    return df.select(*map(quoted, columns))


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(*map(quoted, on)).distinct(), list(on), "left_anti")


def union_split(train: DataFrame, test: DataFrame, name: str = "split") -> DataFrame:
    """Both tables below each other, marked; a column that only one has is NULL in the other."""
    return train.withColumn(name, F.lit("train")).unionByName(
        test.withColumn(name, F.lit("test")), allowMissingColumns=True
    )


def take_split(df: DataFrame, which: str, name: str = "split") -> DataFrame:
    return df.where(col(name) == which).drop(name)


def top_k(df: DataFrame, by: Column, tie: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(by, *tie).limit(k)


def arg_max(df: DataFrame, value: str, key: str) -> DataFrame:
    """The row with the largest value; the smallest key on ties."""
    return df.orderBy(F.desc_nulls_last(quoted(value)), col(key)).limit(1)


def running_best(df: DataFrame, study: str, trial: str, value: str, block: int = 100_000) -> DataFrame:
    """Adds ``best``: the smallest value up to and including each trial of a study.

    The integer trial number cuts a study into blocks. The minimum over earlier
    blocks comes from one row per block, the rest from a window inside the
    block, so that even one huge study is spread over all tasks.
    """
    cut = df.withColumn("__block", col(trial) - F.pmod(col(trial), F.lit(block)))
    per_block = cut.groupBy(quoted(study), "__block").agg(F.min(col(value)).alias("__min"))
    earlier = Window.partitionBy(quoted(study)).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(quoted(study), "__block", F.min("__min").over(earlier).alias("__before"))
    here = Window.partitionBy(quoted(study), "__block").orderBy(quoted(trial)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = cut.withColumn("__here", F.min(col(value)).over(here))
    joined = safe_join(inside, before, [study, "__block"])
    return joined.withColumn("best", F.least("__here", "__before")).drop("__block", "__here", "__before")
