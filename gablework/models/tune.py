"""Random search: a repeatable trial table, its scores, the best trial and the history."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.functions import uniform_hash
from gablework.models.folds import improvement
from gablework.models.histogram import BINS, Grower, binned
from gablework.models.linear import ridge_cv
from gablework.models.trees import plan_of
from gablework.operators.rows import running_best
from gablework.shared import local_frame


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    log: bool = False
    whole: bool = False

    def at(self, u: Column) -> Column:
        if self.log:
            return F.exp(F.log(F.lit(self.low)) + u * (F.log(F.lit(self.high)) - F.log(F.lit(self.low))))
        if self.whole:
            return F.floor(F.lit(self.low) + u * (self.high - self.low + 1)).cast("double")
        return F.lit(self.low) + u * (self.high - self.low)


# The three search spaces and the numbers of trials.
RIDGE_SPACE = {"alpha": Range(0.1, 100.0, log=True)}
_BOOSTED = {
    "n_estimators": Range(100, 1000, whole=True), "learning_rate": Range(0.01, 0.3, log=True),
    "max_depth": Range(3, 8, whole=True), "subsample": Range(0.5, 1.0), "colsample_bytree": Range(0.5, 1.0),
    "reg_alpha": Range(1e-4, 10.0, log=True), "reg_lambda": Range(1e-4, 10.0, log=True),
}
LEAF_SPACE = {**_BOOSTED, "num_leaves": Range(20, 100, whole=True), "min_child_samples": Range(5, 50, whole=True)}
DEPTH_SPACE = {**_BOOSTED, "min_child_weight": Range(1, 10, whole=True)}
TRIALS = {"ridge": 50, "lgb": 100, "xgb": 100}
BASELINE = {"Ridge": 0.1119, "LightGBM": 0.1233, "XGBoost": 0.1207}

TRIAL_SCHEMA = "study string, trial int, params map<string,double>, value double"


def sampled_params(space: Mapping[str, Range], seed: int, trial: Column) -> dict[str, Column]:
    """{parameter: value} of a trial; the same seed, trial and name give the same number."""
    return {p: r.at(uniform_hash(F.lit(seed), trial, F.lit(p))) for p, r in space.items()}


def params_at(space: Mapping[str, Range], seed: int, trial: int) -> dict[str, float]:
    """The same numbers without Spark."""
    out = {}
    for p, r in space.items():
        u = int(hashlib.md5(f"{seed}:{trial}:{p}".encode()).hexdigest()[:8], 16) / 2.0**32
        if r.log:
            out[p] = math.exp(math.log(r.low) + u * (math.log(r.high) - math.log(r.low)))
        else:
            out[p] = float(math.floor(r.low + u * (r.high - r.low + 1))) if r.whole else r.low + u * (r.high - r.low)
    return out


def trial_table(spark: SparkSession, study: str, n: int, space: Mapping[str, Range], seed: int = 42) -> DataFrame:
    """(study, trial, params): n points of the search space."""
    trials = spark.range(n).select(F.col("id").cast("int").alias("trial"))
    params = sampled_params(space, seed, F.col("trial"))
    pairs = [x for p, v in params.items() for x in (F.lit(p), v)]
    return trials.select(F.lit(study).alias("study"), "trial", F.create_map(*pairs).alias("params"))


def tune_ridge(
    df: DataFrame, features: Sequence[str], n: int = 50, seed: int = 42, y: str = "y", k: int = 5, fold: str = "fold",
    scale: bool = True, space: Mapping[str, Range] = RIDGE_SPACE,
) -> DataFrame:
    """Scored trials. All of them are solved from the same sums: the data are read
    once for any number of trials."""
    spark = df.sparkSession
    trials = trial_table(spark, "ridge", n, space, seed).collect()
    scores: dict[float, list[float]] = {}
    for alpha, _, value in ridge_cv(df, features, [t["params"]["alpha"] for t in trials], y, k, fold, scale):
        scores.setdefault(alpha, []).append(value)
    rows = []
    for t in trials:
        s = scores[t["params"]["alpha"]]
        rows.append(("ridge", t["trial"], dict(t["params"]), sum(s) / len(s)))
    return local_frame(spark, rows, TRIAL_SCHEMA)


def tune_boosted(
    df: DataFrame, features: Sequence[str], study: str, n: int, space: Mapping[str, Range], style: str = "depth",
    seed: int = 42, y: str = "y", k: int = 5, fold: str = "fold", key: str | None = None, bins: int = BINS,
) -> DataFrame:
    """Scored trials of boosted trees. The table is binned once, and the trees of all trials and folds are grown in the
    same passes, or each in a task where the table is small (``Grower``)."""
    trials = trial_table(df.sparkSession, study, n, space, seed).collect()
    plans = []
    for t in trials:
        plan = plan_of(study, {**t["params"], "random_state": seed}, style)
        plans += [replace(plan, held=((fold, i),)) for i in range(k)]
    grower = Grower(binned(df, features, y, key, [fold], [y, fold], bins), plans)
    grower.grow(keep=False)
    scored = grower.predicted(only_held=True)
    gap = F.transform(F.slice(F.col("__p"), F.col("__c1") + 1, F.size("__p")), lambda p, i: F.when(i % k == 0, (p - F.col("__c0")) * (p - F.col("__c0"))))
    own = scored.select(F.col("__c1").alias("fold"), F.filter(gap, lambda v: v.isNotNull()).alias("e"))
    errors = own.select("fold", F.posexplode("e").alias("trial", "e")).groupBy("trial", "fold").agg(F.sqrt(F.avg("e")).alias("rmse"))
    value = {r["trial"]: r["value"] for r in errors.groupBy("trial").agg(F.avg("rmse").alias("value")).collect()}
    rows = [(study, t["trial"], dict(t["params"]), value[i]) for i, t in enumerate(trials)]
    return local_frame(df.sparkSession, rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """(study, trial, params, value) with the smallest value per study, the earliest on ties."""
    return trials.groupBy("study").agg(
        F.min("value").alias("value"),
        F.min_by("trial", F.struct("value", "trial")).alias("trial"),
        F.min_by("params", F.struct("value", "trial")).alias("params"),
    ).select("study", "trial", "params", "value")


def history(trials: DataFrame) -> DataFrame:
    """(study, trial, value, best): each trial beside the best so far."""
    return running_best(trials.select("study", "trial", "value"), "study", "trial", "value")


def tuned_vs_base(base: DataFrame, trials: DataFrame) -> DataFrame:
    """(model, base, tuned, improvement %): the best trial of each study against a (model, rmse) table."""
    best = best_trial(trials).select(F.col("study").alias("model"), F.col("value").alias("rmse"))
    return improvement(base, best)
