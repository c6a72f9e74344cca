"""Forests and boosted trees under the parameter names of the usual libraries, grown by ``models.histogram``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from gablework.models.ensemble import Ensemble, importance  # noqa: F401
from gablework.models.histogram import BINS, Grower, Plan, binned

# Parameters of the untuned and the tuned models.
FOREST = {"n_estimators": 500, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2, "random_state": 42}
DEPTH_WISE = {
    "n_estimators": 500, "learning_rate": 0.05, "max_depth": 4, "min_child_weight": 2, "subsample": 0.8,
    "colsample_bytree": 0.8, "reg_alpha": 0.01, "reg_lambda": 1.0, "random_state": 42,
}
LEAF_WISE = {
    "n_estimators": 500, "learning_rate": 0.05, "max_depth": 4, "num_leaves": 31, "min_child_samples": 20,
    "subsample": 0.8, "colsample_bytree": 0.8, "reg_alpha": 0.01, "reg_lambda": 1.0, "random_state": 42,
}
STACKED_DEPTH_WISE = {
    "n_estimators": 300, "learning_rate": 0.05, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.8,
    "random_state": 42,
}
STACKED_LEAF_WISE = {**STACKED_DEPTH_WISE, "num_leaves": 31}
TUNED_DEPTH_WISE = {
    "n_estimators": 953, "learning_rate": 0.017121448472152242, "max_depth": 4, "min_child_weight": 2,
    "subsample": 0.500292621295294, "colsample_bytree": 0.526591163035804, "reg_alpha": 0.003351561224939414,
    "reg_lambda": 0.0002343004339290042, "random_state": 42,
}
TUNED_LEAF_WISE = {
    "n_estimators": 690, "learning_rate": 0.02011820620908632, "max_depth": 6, "num_leaves": 57,
    "min_child_samples": 39, "subsample": 0.506821746158421, "colsample_bytree": 0.5051642633258705,
    "reg_alpha": 0.0005712165849266721, "reg_lambda": 0.002714338283287307, "random_state": 42,
}
# The usual names, and what a plan calls them. A name that is not here is an error.
NAMES = {
    "depth": {
        "n_estimators": "trees", "learning_rate": "rate", "max_depth": "depth", "min_child_weight": "least_weight", "subsample": "row_share",
        "colsample_bytree": "column_share", "reg_alpha": "l1", "reg_lambda": "l2", "random_state": "seed",
    },
    "leaf": {
        "n_estimators": "trees", "learning_rate": "rate", "max_depth": "depth", "num_leaves": "leaves", "min_child_samples": "least_rows",
        "subsample": "row_share", "subsample_freq": "row_share_every", "colsample_bytree": "column_share", "reg_alpha": "l1", "reg_lambda": "l2",
        "random_state": "seed",
    },
    "forest": {
        "n_estimators": "trees", "max_depth": "depth", "min_samples_split": "least_split", "min_samples_leaf": "least_rows", "random_state": "seed",
    },
}
USUAL = {
    "depth": {"trees": 100, "rate": 0.3, "depth": 6, "least_weight": 1.0, "l2": 1.0},
    "leaf": {"trees": 100, "rate": 0.1, "leaves": 31, "least_rows": 20, "least_weight": 1e-3},
    "forest": {"trees": 100, "depth": 64},
}
WHOLE = ("trees", "depth", "leaves", "least_rows", "least_split", "seed")


def plan_of(name: str, params: Mapping[str, float], style: str) -> Plan:
    """A plan from the library's parameters.

    The leaf-wise library samples rows only if a frequency is set; it grows level by level here, so it needs a depth."""
    unknown = [p for p in params if p not in NAMES[style]]
    if unknown:
        raise ValueError(f"unknown parameters {unknown}")
    values = {**USUAL[style], **{NAMES[style][p]: int(v) if NAMES[style][p] in WHOLE else float(v) for p, v in params.items()}}
    every = values.pop("row_share_every", 0)
    if style == "leaf":
        if values.get("depth", 0) < 1:
            raise ValueError("leaf-wise growth needs max_depth")
        if every not in (0, 1):
            raise ValueError("rows are sampled for every tree or for none")
        if not every:
            values["row_share"] = 1.0
    return Plan(name=name, style=style, **values)


@dataclass(frozen=True)
class TreeFitter:
    """Fits one ensemble; ``key`` names the rows when they are sampled (without it, their content does)."""

    features: tuple[str, ...]
    plan: Plan
    y: str = "y"
    key: str | None = None
    bins: int = BINS

    def __call__(self, df: DataFrame) -> Ensemble:
        table = binned(df, self.features, self.y, self.key, [], [], self.bins)
        fit = Grower(table, [self.plan]).grow()[0]
        return replace(fit, features=list(self.features))


def forest(features: Sequence[str], params: Mapping[str, float] = FOREST, y: str = "y", key: str | None = None, bins: int = BINS) -> TreeFitter:
    return TreeFitter(tuple(features), plan_of("forest", params, "forest"), y, key, bins)


def boosted(
    features: Sequence[str], params: Mapping[str, float] = DEPTH_WISE, y: str = "y", style: str = "depth", key: str | None = None, bins: int = BINS,
) -> TreeFitter:
    """``style='depth'`` reads the names of the depth-wise library, ``'leaf'`` those of the leaf-wise one."""
    return TreeFitter(tuple(features), plan_of(style, params, style), y, key, bins)
