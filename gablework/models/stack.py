"""Stacking: out-of-fold predictions of the bases feed a ridge on top."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gablework.models.folds import Fitter, Predictor, fit_all, keep_folds, out_of_fold
from gablework.models.linear import LinearFit, fit_linear
from gablework.shared import col, materialize

INNER = "__inner"


@dataclass
class StackFit:
    bases: dict[str, Predictor]
    top: LinearFit

    def add(self, df: DataFrame, name: str) -> DataFrame:
        out = df
        for base, model in self.bases.items():
            out = model.add(out, f"__base_{base}")
        return self.top.add(out, name).drop(*[f"__base_{b}" for b in self.bases])


@dataclass(eq=False)
class StackFitter:
    """Inner folds come from the key with their own seed, the top model sees out-of-fold predictions only, and the
    bases are refitted on all rows. ``models.graph.CrossFit`` fits the same stack for many training sets at once."""

    bases: Mapping[str, Fitter]
    key: str
    y: str = "y"
    alpha: float = 10.0
    k: int = 5
    seed: int = 43

    def __call__(self, df: DataFrame) -> StackFit:
        inner = keep_folds(df, self.key, self.k, self.seed, INNER)
        named = {f"__base_{n}": f for n, f in self.bases.items()}
        held = out_of_fold(inner, named, self.k, INNER).select(*[col(n) for n in named], col(self.y))
        top = fit_linear(materialize(held, "stack"), list(named), self.y, self.alpha, None, scale=False)
        return StackFit(fit_all(df, self.bases), top)


def stacking(
    bases: Mapping[str, Fitter], key: str, y: str = "y", alpha: float = 10.0, k: int = 5, seed: int = 43
) -> StackFitter:
    return StackFitter(dict(bases), key, y, alpha, k, seed)
