"""Attribution of a linear model: weight times distance from the mean, exact and without a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.models.linear import LinearFit
from gablework.shared import col


def linear_attributions(df: DataFrame, fit: LinearFit, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., base, contributions): contributions in the order of ``fit.features``.

    base + sum of contributions = prediction.
    """
    means = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(fit.features)]).first()
    mean = [m if m is not None else 0.0 for m in means]
    base = fit.intercept + sum(w * m for w, m in zip(fit.coefficients, mean))
    parts = [
        F.lit(float(w)) * (col(c).cast("double") - F.lit(float(m)))
        for c, w, m in zip(fit.features, fit.coefficients, mean)
    ]
    return df.select(
        col(key), *[col(c) for c in keep], F.lit(float(base)).alias("base"), F.array(*parts).alias("contributions")
    )
