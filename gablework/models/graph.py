"""Cross-validation of many models at once: every (model, rows left out) is fitted once and used wherever it is needed.

Linear models of all training sets are solved from the same sums; trees of all training sets are grown in the same passes.
Stacking needs its bases without an outer fold, and without an outer and an inner fold; the blend and the
comparison use the former again. The top models of all outer folds come from one more pass of sums over the bases'
predictions, so nothing is refitted and no row is copied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.functions import fold_of
from gablework.models.folds import rmse
from gablework.models.histogram import Grower, binned
from gablework.models.linear import LinearFit, LinearFitter, Moments, cell_moments, scales_of, solved
from gablework.models.stack import StackFitter
from gablework.models.trees import TreeFitter
from gablework.operators.quantile import union_quantiles
from gablework.shared import col, materialize

Held = tuple[tuple[str, int], ...]
INNER = "__inner"


@dataclass(frozen=True)
class Need:
    """One fit: a base and the (fold column, fold) pairs that it must not see."""

    base: LinearFitter | TreeFitter
    held: Held


class FitGraph:
    """Fits all needs on ``df`` (which holds the fold columns) and gives their predictions as columns of ``rows``."""

    def __init__(self, df: DataFrame, needs: Sequence[Need], y: str, key: str, folds: Sequence[str]):
        self.y, self.key, self.folds = y, key, list(folds)
        needs = list(dict.fromkeys(needs))
        linear = [n for n in needs if isinstance(n.base, LinearFitter)]
        trees = [n for n in needs if isinstance(n.base, TreeFitter)]
        self.linear = self._linear(df, linear)
        self.place = {n: i for i, n in enumerate(trees)}
        if not trees:
            self.rows = df
            return
        shapes = {(n.base.features, n.base.bins) for n in trees}
        if len(shapes) > 1:
            raise ValueError("trees that are grown together need the same features and bins")
        (features, bins), = shapes
        carry = list(dict.fromkeys([key, y, *self.folds, *(c for n in linear for c in n.base.features)]))
        table = binned(df, features, y, key, self.folds, carry, bins)
        grower = Grower(table, [replace(n.base.plan, held=n.held) for n in trees])
        grower.grow(keep=False)
        found = grower.predicted(only_held=True)
        self.rows = materialize(found.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], "__p"), "predicted")

    def _linear(self, df: DataFrame, needs: Sequence[Need]) -> dict[Need, LinearFit]:
        out: dict[Need, LinearFit] = {}
        for features in dict.fromkeys(n.base.features for n in needs):
            own = [n for n in needs if n.base.features == features]
            cells, origin = cell_moments(df, list(features), self.y, self.folds)
            numbers = {c: i for i, c in enumerate(cells)}
            seen = {h: [c for c in cells if all(c[self.folds.index(f)] != v for f, v in h)] for h in dict.fromkeys(n.held for n in own)}
            scales = dict.fromkeys(seen)
            if any(n.base.scale for n in own):
                number = F.lit(None).cast("int")
                for c, i in numbers.items():
                    number = F.when(self._in(c), F.lit(i)).otherwise(number)
                unions = [[numbers[c] for c in s] for s in seen.values()]
                quartiles = union_quantiles(df.withColumn("__cell", number), features, [0.25, 0.5, 0.75], "__cell", unions)
                scales = {h: scales_of(q) for h, q in zip(seen, quartiles)}
            sums = {h: Moments(sum(cells[c].gram for c in s)) for h, s in seen.items()}
            for n in own:
                out[n] = solved(sums[n.held], origin, features, scales[n.held] if n.base.scale else None, n.base.alpha, n.base.l1_ratio)
        return out

    def _in(self, cell: Sequence[int]) -> Column:
        out = F.lit(True)
        for f, v in zip(self.folds, cell):
            out = out & (col(f) == v)
        return out

    def predicted(self, need: Need) -> Column:
        """A column of ``rows``, defined for the rows that the fit has not seen."""
        return self.linear[need].predict() if need in self.linear else F.col("__p")[self.place[need]]


class CrossFit:
    """Every model fitted without each of the folds ``held`` (all, unless given), and its predictions for that fold."""

    def __init__(
        self, df: DataFrame, models: Mapping[str, LinearFitter | TreeFitter | StackFitter], key: str, y: str = "y", k: int = 5, fold: str = "fold",
        held: Sequence[int] | None = None,
    ):
        self.models, self.fold, self.y, self.key = dict(models), fold, y, key
        self.held = list(range(k)) if held is None else list(held)
        self.stacks = {n: m for n, m in self.models.items() if isinstance(m, StackFitter)}
        inner = {(m.k, m.seed) for m in self.stacks.values()}
        if len(inner) > 1:
            raise ValueError("stacks that are fitted together need the same inner folds")
        needs, folds = [], [fold]
        if inner:
            (self.inner_k, seed), = inner
            df, folds = df.withColumn(INNER, fold_of(col(key), self.inner_k, seed)), [fold, INNER]
        for i in self.held:
            for m in self.models.values():
                for base in m.bases.values() if isinstance(m, StackFitter) else [m]:
                    needs.append(Need(base, ((fold, i),)))
                    if isinstance(m, StackFitter):
                        needs += [Need(base, ((fold, i), (INNER, j))) for j in range(self.inner_k)]
        self.graph = FitGraph(df, needs, y, key, folds)
        self.tops = {n: self._tops(m) for n, m in self.stacks.items()}

    def _input(self, base: LinearFitter | TreeFitter, i: int) -> Column:
        """What a top model without fold ``i`` gets from a base: by the fit without the row's inner fold, for rows of
        fold ``i`` by the fit on all others."""
        out = F.lit(None).cast("double")
        for j in range(self.inner_k):
            out = F.when(col(INNER) == j, self.graph.predicted(Need(base, ((self.fold, i), (INNER, j))))).otherwise(out)
        return F.when(col(self.fold) == i, self.graph.predicted(Need(base, ((self.fold, i),)))).otherwise(out)

    def _tops(self, stack: StackFitter) -> dict[int, LinearFit]:
        names = {i: [f"__in{i}_{b}" for b in stack.bases] for i in self.held}
        inputs = self.graph.rows.select(
            col(self.y), col(self.fold).alias("__fold"),
            *[self._input(b, i).alias(n) for i in self.held for n, b in zip(names[i], stack.bases.values())],
        )
        kept = materialize(inputs, "stack")
        flat = [n for i in self.held for n in names[i]]
        cells, origin = cell_moments(kept, flat, self.y, ["__fold"])
        out = {}
        for i in self.held:
            at = [0, *[1 + flat.index(n) for n in names[i]], len(flat) + 1]
            train = Moments(sum(m.gram for c, m in cells.items() if c[0] != i)[at][:, at])
            out[i] = solved(train, origin[[a - 1 for a in at[1:]]], list(stack.bases), None, stack.alpha, None)
        return out

    def predicted(self, name: str, i: int) -> Column:
        model = self.models[name]
        if name not in self.stacks:
            return self.graph.predicted(Need(model, ((self.fold, i),)))
        top = self.tops[name][i]
        out = F.lit(top.intercept)
        for w, base in zip(top.coefficients, model.bases.values()):
            out = out + F.lit(float(w)) * self.graph.predicted(Need(base, ((self.fold, i),)))
        return out

    def out_of_fold(self) -> DataFrame:
        """(key, y, fold, one column per model) of the rows of the folds left out, predicted by models that never saw them."""
        columns = []
        for name in self.models:
            out = F.lit(None).cast("double")
            for i in self.held:
                out = F.when(col(self.fold) == i, self.predicted(name, i)).otherwise(out)
            columns.append(out.alias(name))
        rows = self.graph.rows.where(col(self.fold).isin(self.held))
        return rows.select(col(self.key), col(self.y), col(self.fold), *columns)

    def scores(self) -> DataFrame:
        """(model, fold, rmse)."""
        scored = self.out_of_fold().groupBy(col(self.fold).alias("fold")).agg(*[rmse(col(self.y), col(n)).alias(n) for n in self.models])
        return scored.unpivot(["fold"], list(self.models), "model", "rmse").select("model", "fold", "rmse")
