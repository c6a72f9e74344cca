"""Ridge, lasso and elastic net with the usual alpha, on robust-scaled features.

Spark divides the L2 part of its penalty by the label's standard deviation and
counts loss per row; ``_penalty`` converts. The scaling is folded back into the
coefficients, so a fitted model is a set of literals and scoring a projection.

Cross-validated ridge needs no refit at all: the cross-product sums of each fold
are gathered in one pass, the sums of a training set are the total minus the
fold, and every alpha is solved from them.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.models.folds import rmse, side_by_side
from gablework.operators.encode import robust_params, scaled
from gablework.operators.gram import cross_sums, matrices, means
from gablework.operators.quantile import union_quantiles
from gablework.shared import col

# The normal equations are solved on one machine; they grow with the columns, not with the rows.
MAX_FEATURES = 4096


@dataclass
class LinearFit:
    features: list[str]
    coefficients: list[float]
    intercept: float

    def predict(self) -> Column:
        terms = [F.lit(float(w)) * col(c).cast("double") for c, w in zip(self.features, self.coefficients) if w != 0.0]
        return functools.reduce(operator.add, terms, F.lit(float(self.intercept)))

    def add(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, self.predict())


def _unscaled(
    features: Sequence[str], scaled_w: Sequence[float], scaled_b: float, params: dict[str, tuple[float, float]]
) -> LinearFit:
    w = [float(v) / params[c][1] for c, v in zip(features, scaled_w)]
    b = float(scaled_b) - sum(v * params[c][0] for c, v in zip(features, w))
    return LinearFit(list(features), w, b)


def _penalty(alpha: float, l1_ratio: float | None, n: int, sd: float) -> tuple[float, float]:
    """(regParam, elasticNetParam). ``l1_ratio=None`` is ridge, whose alpha is not per row."""
    l1 = 0.0 if l1_ratio is None else alpha * l1_ratio
    l2 = alpha / n if l1_ratio is None else alpha * (1 - l1_ratio)
    reg = l1 + l2 * sd
    return reg, (l1 / reg if reg else 0.0)


def label_stats(df: DataFrame, y: str = "y") -> tuple[int, float, float]:
    """(rows, mean, population deviation) of the label."""
    label = col(y).cast("double")
    s = df.agg(F.count(label).alias("n"), F.avg(label).alias("mean"), F.stddev_pop(label).alias("sd")).first()
    return s["n"], s["mean"] or 0.0, s["sd"] or 0.0


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    y: str = "y",
    alpha: float = 10.0,
    l1_ratio: float | None = None,
    scale: bool = True,
    params: dict[str, tuple[float, float]] | None = None,
    stats: tuple[int, float, float] | None = None,
) -> LinearFit:
    """Ridge (``l1_ratio=None``), lasso (``1.0``) or elastic net (between).

    ``params`` (median and IQR per feature) and ``stats`` (of the label) are
    measured when not given.
    """
    features = list(features)
    if len(features) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    require_values(df, [*features, y])
    if params is None:
        params = robust_params(df, features) if scale else dict.fromkeys(features, (0.0, 1.0))
    n, mean, sd = stats or label_stats(df, y)
    if sd == 0:
        return LinearFit(features, [0.0] * len(features), mean)
    reg, mix = _penalty(alpha, l1_ratio, n, sd)
    vectors = df.select(
        array_to_vector(F.array(*[scaled(c, params[c]) for c in features])).alias("x"), col(y).cast("double").alias("y")
    )
    solver = LinearRegression(
        featuresCol="x", labelCol="y", regParam=reg, elasticNetParam=mix, standardization=False,
        solver="normal", tol=1e-10, maxIter=10_000,
    )
    model = solver.fit(vectors)
    return _unscaled(features, model.coefficients.toArray(), model.intercept, params)


@dataclass(frozen=True)
class LinearFitter:
    """Fits one linear model."""

    features: tuple[str, ...]
    alpha: float
    l1_ratio: float | None = None
    y: str = "y"
    scale: bool = True

    def __call__(self, df: DataFrame) -> LinearFit:
        return fit_linear(df, self.features, self.y, self.alpha, self.l1_ratio, self.scale)


def ridge(features: Sequence[str], alpha: float = 10.0, y: str = "y", scale: bool = True) -> LinearFitter:
    return LinearFitter(tuple(features), alpha, None, y, scale)


def lasso(features: Sequence[str], alpha: float = 0.0005, y: str = "y", scale: bool = True) -> LinearFitter:
    return LinearFitter(tuple(features), alpha, 1.0, y, scale)


def elastic_net(features: Sequence[str], alpha: float = 0.0005, l1_ratio: float = 0.9, y: str = "y", scale: bool = True) -> LinearFitter:
    return LinearFitter(tuple(features), alpha, l1_ratio, y, scale)


# Cross-validated ridge from sums

@dataclass
class Moments:
    """Sums of [1, x..., y] times itself, about a fixed origin."""

    gram: np.ndarray

    @property
    def n(self) -> float:
        return float(self.gram[0, 0])

    def means(self) -> tuple[np.ndarray, float]:
        m = self.gram[0, 1:] / self.n
        return m[:-1], float(m[-1])

    def about(self, mx: np.ndarray, my: float) -> np.ndarray:
        """Cross-products of [x..., y] about another centre."""
        c = np.append(mx, my)
        s = self.gram[0, 1:]
        return self.gram[1:, 1:] - np.outer(c, s) - np.outer(s, c) + self.n * np.outer(c, c)


def require_values(df: DataFrame, columns: Sequence[str]) -> None:
    """Missing values are an error that names their columns."""
    row = df.agg(F.count(F.lit(1)), *[F.count(F.nanvl(col(c).cast("double"), F.lit(None))).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    gaps = [c for c, n in zip(columns, row[1:]) if n < row[0]]
    if gaps:
        raise ValueError(f"missing values in {gaps}")


def cell_moments(df: DataFrame, features: Sequence[str], y: str, cells: Sequence[str]) -> tuple[dict[tuple[int, ...], Moments], np.ndarray]:
    """({cell: sums}, origin): one pass over the data for all combinations of the cell columns."""
    columns = [*features, y]
    if len(features) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    require_values(df, [*columns, *cells])
    origin = means(df, columns)
    return {c: Moments(g) for c, g in matrices(cross_sums(df, columns, cells, origin)).items()}, origin


def fold_moments(df: DataFrame, features: Sequence[str], y: str = "y", fold: str = "fold") -> tuple[dict[int, Moments], np.ndarray]:
    """({fold: sums}, origin): one pass over the data for all folds."""
    found, origin = cell_moments(df, list(features), y, [fold])
    return {c[0]: m for c, m in found.items()}, origin


def scales_of(quartiles: dict[str, list[float]]) -> dict[str, tuple[float, float]]:
    """{column: (median, IQR)}; an IQR of zero, or of an empty column, counts as one."""
    return {c: (m if m is not None else 0.0, b - a if m is not None and b > a else 1.0) for c, (a, m, b) in quartiles.items()}


def fold_scales(df: DataFrame, features: Sequence[str], k: int = 5, fold: str = "fold") -> dict[int, dict[str, tuple[float, float]]]:
    """{held-out fold: {column: (median, IQR)}} of each training set, from one table of counts for all folds."""
    others = [[f for f in range(k) if f != i] for i in range(k)]
    return {i: scales_of(q) for i, q in enumerate(union_quantiles(df, features, [0.25, 0.5, 0.75], fold, others))}


def solved(train: Moments, origin: np.ndarray, features: Sequence[str], scales: dict[str, tuple[float, float]] | None, alpha: float, l1_ratio: float | None) -> LinearFit:
    """The model of a training set from its sums: ridge by one solve, models with an L1 part by coordinate descent."""
    mx, my = train.means()
    inside = train.about(mx, my)
    d = np.array([1 / scales[c][1] for c in features]) if scales else np.ones(len(features))
    sxx, sxy = inside[:-1, :-1] * np.outer(d, d), inside[:-1, -1] * d
    if l1_ratio is None:
        w = np.linalg.solve(sxx + alpha * np.eye(len(d)), sxy) * d
    else:
        w = descended(sxx / train.n, sxy / train.n, alpha * l1_ratio, alpha * (1 - l1_ratio)) * d
    return LinearFit(list(features), w.tolist(), float(my + origin[-1] - w @ (mx + origin[:-1])))


def descended(s: np.ndarray, c: np.ndarray, l1: float, l2: float, sweeps: int = 100_000, tol: float = 1e-13) -> np.ndarray:
    """Minimises w's/2 - c'w + l1 |w| + l2 w'w / 2 one coordinate after the other."""
    w, left = np.zeros(len(c)), c.copy()  # left: c - s w
    size = np.diag(s) + l2
    reach = max(np.abs(c).max(initial=0.0), 1e-300)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(size > 0):
            z = left[j] + s[j, j] * w[j]
            new = np.sign(z) * max(abs(z) - l1, 0.0) / size[j]
            if new != w[j]:
                left -= s[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * size[j])
                w[j] = new
        if moved <= tol * reach:
            break
    return w


def ridge_cv(
    df: DataFrame, features: Sequence[str], alphas: Sequence[float], y: str = "y", k: int = 5, fold: str = "fold",
    scale: bool = True,
) -> list[tuple[float, int, float]]:
    """[(alpha, fold, rmse)] for any number of alphas from one pass of sums (and one of quantiles).

    One eigendecomposition per fold serves all alphas."""
    features = list(features)
    sums, _ = fold_moments(df, features, y, fold)
    scales = fold_scales(df, features, k, fold) if scale else None
    whole = sum(m.gram for m in sums.values())
    out = []
    for held, test in sums.items():
        train = Moments(whole - test.gram)
        mx, my = train.means()
        inside, outside = train.about(mx, my), test.about(mx, my)
        d = np.array([1 / scales[held][c][1] for c in features]) if scales else np.ones(len(features))
        values, vectors = np.linalg.eigh(inside[:-1, :-1] * np.outer(d, d))
        along = vectors.T @ (inside[:-1, -1] * d)
        for alpha in alphas:
            w = vectors @ (along / (np.maximum(values, 0.0) + alpha)) * d
            sse = outside[-1, -1] - 2 * w @ outside[:-1, -1] + w @ outside[:-1, :-1] @ w
            out.append((float(alpha), int(held), float(np.sqrt(max(sse, 0.0) / test.n))))
    return out


def linear_cv(
    df: DataFrame, features: Sequence[str], alpha: float, l1_ratio: float | None, y: str = "y", k: int = 5,
    fold: str = "fold", scale: bool = True,
) -> DataFrame:
    """(fold, rmse) of a linear model refitted per fold.

    Scaling and label statistics of all training sets come from one pass each,
    and as the fitted models are literals, all folds are scored in one pass.
    """
    features = list(features)
    require_values(df, [*features, y, fold])
    params = fold_scales(df, features, k, fold) if scale else dict.fromkeys(range(k))
    label = col(y).cast("double")
    others = [F.when(col(fold) != i, label) for i in range(k)]
    spread = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(others) for n, f in (("n", F.count), ("mean", F.avg), ("sd", F.stddev_pop))]).first()
    stats = {i: (spread[f"n{i}"], spread[f"mean{i}"] or 0.0, spread[f"sd{i}"] or 0.0) for i in range(k)}
    fits = side_by_side(df.sparkSession, [
        lambda i=i: fit_linear(df.where(col(fold) != i), features, y, alpha, l1_ratio, scale, params[i], stats[i])
        for i in range(k)
    ])
    predicted = F.lit(None).cast("double")
    for i, fit in enumerate(fits):
        predicted = F.when(col(fold) == i, fit.predict()).otherwise(predicted)
    return df.groupBy(col(fold).alias("fold")).agg(rmse(col(y), predicted).alias("rmse"))
