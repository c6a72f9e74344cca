"""Column expressions: the formulas, kept inside generated code."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skew(x: Column) -> Column:
    """Bias-adjusted sample skewness G1 of the present values.

    Fewer than three values give NULL; a constant column gives 0.
    """
    x = x.cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n < 3, F.lit(None).cast("double")).when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(
        g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    )


def guarded_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either is constant."""
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a.cast("double"))
    y = F.when(both, b.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def log1p_or_null(x: Column) -> Column:
    return F.log1p(x.cast("double"))


def weighted_sum(weights: Mapping[str, float] | list[tuple[str, float]]) -> Column:
    """Sum of weight times column; NULL as soon as one term is NULL."""
    pairs = weights.items() if isinstance(weights, Mapping) else weights
    terms = [F.col(f"`{c}`") if w == 1 else F.lit(float(w)) * F.col(f"`{c}`") for c, w in pairs]
    return functools.reduce(operator.add, terms)


def differs(a: Column, b: Column) -> Column:
    """1 where the two differ or either is missing, else 0."""
    return F.coalesce(a != b, F.lit(True)).cast("int")


def present(x: Column) -> Column:
    """1 where the value is above zero, else 0 (missing counts as 0)."""
    return F.coalesce(x > 0, F.lit(False)).cast("int")


def price_error(y: Column, predicted: Column) -> Column:
    """Absolute error in original units of a log1p-scale prediction."""
    return F.abs(F.expm1(y) - F.expm1(predicted))


def _md5_32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def fold_of(key: Column, k: int = 5, seed: int = 42) -> Column:
    """Shuffled fold number from the key alone: same row, same fold, on any
    partitioning. Sizes are equal only in expectation."""
    return (_md5_32(F.concat(F.lit(f"{seed}:"), key.cast("string"))) % k).cast("int")


def uniform_hash(*parts: Column) -> Column:
    """A repeatable uniform number in [0, 1) from the given parts."""
    return _md5_32(F.concat_ws(":", *[p.cast("string") for p in parts])) / F.lit(float(2**32))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)
