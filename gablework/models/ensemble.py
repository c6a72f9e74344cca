"""Fitted tree ensembles: arrays of nodes, scored in Arrow batches."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Tree:
    """Nodes of one tree; ``feature`` is -1 at a leaf. Rows with x <= threshold (or bin <= ``bin``) go left."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    depth: int

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node that each binned row has come to."""
        return self._walk(bins, self.bin)

    def scored(self, x: np.ndarray) -> np.ndarray:
        return self.value[self._walk(x, self.threshold)]

    def _walk(self, x: np.ndarray, cut: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int32), np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            low = x[rows, np.maximum(f, 0)] <= cut[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
        return at


@dataclass
class Ensemble:
    """Trees whose values are added to ``base``, or averaged."""

    trees: list[Tree]
    base: float
    how: str  # "sum" or "mean"
    features: list[str] = field(default_factory=list)

    def scored(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t in self.trees:
            total += t.scored(x)
        return self.base + total / (len(self.trees) if self.how == "mean" else 1)

    def predict(self) -> Column:
        from gablework.shared import col  # the class goes to tasks, which need not have the package

        model = self

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            if np.isnan(x).any():
                raise ValueError(f"missing values in {model.features}")
            return pd.Series(model.scored(x))

        return score(*[col(c).cast("double") for c in self.features])

    def add(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, self.predict())


def importance(fit: Ensemble, spark) -> DataFrame:
    """(feature, importance): mean gain of a feature's splits, as a share of all features' means; the largest first."""
    gain, splits = np.zeros(len(fit.features)), np.zeros(len(fit.features))
    for t in fit.trees:
        inner = t.feature >= 0
        np.add.at(gain, t.feature[inner], t.gain[inner])
        np.add.at(splits, t.feature[inner], 1)
    mean = gain / np.maximum(splits, 1)
    shares = mean / mean.sum() if mean.sum() else mean
    rows = [(c, float(s)) for c, s in zip(fit.features, shares)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
