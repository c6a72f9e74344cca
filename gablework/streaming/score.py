"""Fitted plans and models on a stream.

Both are projections over literals, so a stream of raw rows is prepared and
scored by the very code that serves a table; there is no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gablework.models.folds import Predictor
from gablework.plans.prep import PrepPlan
from gablework.shared import scratch_path


def score_stream(rows: DataFrame, plan: PrepPlan | None, model: Predictor, name: str = "prediction") -> DataFrame:
    return model.add(plan.transform(rows) if plan else rows, name)


def write_stream(scored: DataFrame, path: str, state: str | None = None) -> StreamingQuery:
    """Append scored rows to a table, exactly once; ends when the present input is done."""
    state = state or scratch_path(scored.sparkSession, "stream")
    return (
        scored.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
