"""Folds from the key, scores per fold, and the comparison table.

A fitted predictor is anything with ``add(df, name)`` that returns ``df`` with a
prediction column. A fitter is a function ``DataFrame -> predictor``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.functions import fold_of
from gablework.shared import col, local_frame, materialize

PARALLEL_FITS = 4
SCORES = "model string, fold int, rmse double"


class Predictor(Protocol):
    def add(self, df: DataFrame, name: str) -> DataFrame: ...


Fitter = Callable[[DataFrame], Predictor]


def with_fold(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(col(key), k, seed))


def keep_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """The table with folds, written once and laid out by fold: the many fits of a
    cross-validation read it again and again, and each skips the fold left out."""
    return materialize(with_fold(df, key, k, seed, name), "folds", by=name)


def rmse(y: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((y - predicted) * (y - predicted)))


def side_by_side(spark: SparkSession, tasks: Sequence[Callable], parallelism: int = PARALLEL_FITS) -> list:
    """Results of independent Spark calls in order, a few at a time: small fits do not fill a cluster alone."""
    with ThreadPool(min(parallelism, max(len(tasks), 1))) as pool:
        return pool.map(lambda t: t(), [inheritable_thread_target(spark)(t) for t in tasks])


def out_of_fold(
    df: DataFrame, fitters: Mapping[str, Fitter], k: int = 5, fold: str = "fold"
) -> DataFrame:
    """``df`` with one column per fitter, predicted by a model that never saw the row's fold.

    The models of one fold add their columns one after the other, so nothing is joined.
    """
    wanted = [(i, name) for i in range(k) for name in fitters]
    fits = side_by_side(df.sparkSession, [lambda i=i, n=n: fitters[n](df.where(col(fold) != i)) for i, n in wanted])
    parts = [df.where(col(fold) == i) for i in range(k)]
    for (i, name), fit in zip(wanted, fits):
        parts[i] = fit.add(parts[i], name)
    return functools.reduce(DataFrame.unionByName, parts)


def cv_scores(df: DataFrame, fitters: Mapping[str, Fitter], y: str = "y", k: int = 5, fold: str = "fold") -> DataFrame:
    """(model, fold, rmse): one refit per fold, scored on the fold left out."""
    held = out_of_fold(df, fitters, k, fold)
    scored = held.groupBy(col(fold).alias("fold")).agg(*[rmse(col(y), col(n)).alias(n) for n in fitters])
    return scored.unpivot(["fold"], list(fitters), "model", "rmse").select("model", "fold", "rmse")


def compare(scores: DataFrame) -> DataFrame:
    """(model, mean, std): mean of the fold scores and their population deviation, best first."""
    return scores.groupBy("model").agg(F.avg("rmse").alias("mean"), F.stddev_pop("rmse").alias("std")).orderBy(
        "mean", "model"
    )


def score_frame(spark, rows: Sequence[tuple[str, int, float]]) -> DataFrame:
    return local_frame(spark, [(m, int(f), float(r)) for m, f, r in rows], SCORES)


def improvement(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """(model, base, tuned, improvement %) of two (model, rmse) tables."""
    both = base.select("model", F.col("rmse").alias("base")).join(
        tuned.select("model", F.col("rmse").alias("tuned")), "model"
    )
    gain = (F.col("base") - F.col("tuned")) / F.nullif(F.col("base"), F.lit(0.0)) * 100
    return both.withColumn("improvement", gain)


def fit_all(df: DataFrame, fitters: Mapping[str, Fitter]) -> dict[str, Predictor]:
    """Every model on the whole table."""
    fits = side_by_side(df.sparkSession, [lambda f=f: f(df) for f in fitters.values()])
    return dict(zip(fitters, fits))


def predict_all(df: DataFrame, fits: Mapping[str, Predictor]) -> DataFrame:
    """One prediction column per model, beside the row's own columns."""
    for name, fit in fits.items():
        df = fit.add(df, name)
    return df


def blend(weights: Mapping[str, float]) -> Column:
    """Weighted sum of prediction columns; the weights must add up to one."""
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("blend weights must sum to 1")
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + F.lit(float(w)) * col(name)
    return total


# The two blends of the final predictions.
BLEND_FIVE = {"ridge": 0.1, "lasso": 0.1, "xgb": 0.3, "lgb": 0.3, "stacking": 0.2}
BLEND_TUNED = {"ridge": 0.2, "lgb": 0.4, "xgb": 0.4}
