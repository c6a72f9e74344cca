"""Run log: one appended row per run, read back by query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.shared import local_frame

RUN_SCHEMA = "run string, params map<string,string>, metrics map<string,double>"


def log_run(spark: SparkSession, path: str, run: str, params: Mapping, metrics: Mapping[str, float]) -> None:
    row = (run, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})
    frame = local_frame(spark, [row], RUN_SCHEMA).withColumn("ts", F.current_timestamp())
    frame.coalesce(1).write.mode("append").parquet(path)


def log_scores(spark: SparkSession, path: str, scores: DataFrame, params: Mapping[str, Mapping]) -> None:
    """One run per model of a (model, fold, rmse) table: mean and population deviation of the fold scores."""
    for r in scores.groupBy("model").agg(F.avg("rmse").alias("m"), F.stddev_pop("rmse").alias("s")).collect():
        log_run(spark, path, r["model"], params.get(r["model"], {}), {"rmse_mean": r["m"], "rmse_std": r["s"]})


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, params, metrics, ts), the oldest first."""
    return spark.read.parquet(path).orderBy("ts", "run")


def best_run(spark: SparkSession, path: str, metric: str = "rmse_mean") -> DataFrame:
    return read_runs(spark, path).orderBy(F.col("metrics")[metric], "run").limit(1)
