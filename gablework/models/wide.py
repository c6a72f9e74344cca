"""Cross-validated ridge on sparse rows of any width, by conjugate gradients with the diagonal as preconditioner.

Equal sparse rows are counted once, with the rows and labels of each fold. All vectors (weights, residuals, directions) are
columns of one table by feature, a column per (fold left out, alpha), which is written once a step: entries meet
directions by feature, are summed by row, and go back by feature. A step sends a few numbers per system to the driver. Features
are not scaled, the intercept is free.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.shared import col, materialize

TOGETHER = 16  # systems solved side by side: columns of the table of vectors
STEPS, TOLERANCE = 500, 1e-12


@dataclass
class WideFit:
    """``table``: (place, weights by the name ``column``); a place that is not there has weight 0."""

    table: DataFrame
    column: str
    width: int
    intercept: float

    @property
    def weights(self) -> np.ndarray:
        """All weights on the driver, for models that are not too wide for it."""
        out = np.zeros(self.width)
        found = self.table.select("place", self.column).toArrow()
        out[found.column(0).to_numpy()] = found.column(1).to_numpy()
        return out


@dataclass
class Patterns:
    """Different sparse rows (pid, and per fold n, s, v: rows, sum and variance of labels) and their entries (pid, place, x)."""

    rows: DataFrame
    entries: DataFrame
    folds: list[int]
    n: dict[int, int]
    total: dict[int, float]

    def outside(self, name: str, held: int | None) -> Column:
        return functools.reduce(operator.add, [F.col(f"{name}{i}") for i, f in enumerate(self.folds) if f != held], F.lit(0.0))

    def along(self, vectors: DataFrame, names: Sequence[str]) -> DataFrame:
        """(pid, ...): the product of every row with each vector."""
        met = self.entries.join(vectors.select("place", *names), "place")
        return met.groupBy("pid").agg(*[F.sum(F.col("x") * F.col(c)).alias(c) for c in names])


def patterns(df: DataFrame, features: str, y: str, fold: str) -> Patterns:
    entries = col(features)
    label = F.coalesce(col(y).cast("double"), F.lit(float("nan")))
    plain = df.select(entries["indices"].alias("indices"), entries["values"].alias("values"), label.alias("y"), col(fold).cast("int").alias("fold"))
    counts = {r["fold"]: r for r in plain.groupBy("fold").agg(F.count("y").alias("n"), F.sum("y").alias("s")).collect()}
    folds = sorted(counts)
    own = [F.when(F.col("fold") == f, F.col("y")) for f in folds]
    sums = [c for i, v in enumerate(own) for c in (
        F.count(v).cast("double").alias(f"n{i}"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s{i}"), F.coalesce(F.var_pop(v), F.lit(0.0)).alias(f"v{i}"))]
    rows = plain.groupBy("indices", "values").agg(*sums).withColumn("pid", F.monotonically_increasing_id())
    rows = materialize(rows, "patterns")
    pairs = rows.select("pid", F.explode(F.arrays_zip("indices", "values")).alias("e"))
    entries = materialize(pairs.select("pid", F.col("e.indices").alias("place"), F.col("e.values").alias("x")), "entries")
    return Patterns(rows, entries, folds, {f: counts[f]["n"] for f in folds}, {f: counts[f]["s"] or 0.0 for f in folds})


def _sums(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """One number per column."""
    return np.array([v or 0.0 for v in df.agg(*[F.sum(c).alias(f"a{i}") for i, c in enumerate(columns)]).first()])


def _solved(found: Patterns, moments: DataFrame, systems: Sequence[tuple[int, int | None, float]], n: np.ndarray, mean_y: np.ndarray, width: int) -> list[WideFit]:
    """``systems``: (number of the fold in ``moments``, fold, alpha)."""
    count, of = len(systems), [i for i, _, _ in systems]
    column = F.col

    def names(kind: str) -> list[str]:
        return [f"{kind}{j}" for j in range(count)]

    mean = [column(f"m{i}") for i in of]
    size = [column(f"q{i}") - F.lit(float(n[i])) * m * m + F.lit(a) for m, (i, _, a) in zip(mean, systems)]
    scale = [F.when(s > 0, s).otherwise(F.lit(1.0)) for s in size]
    fixed = [c for c in moments.columns if not c.startswith("t")]
    start = [column(f"t{i}") - mean[j] * F.lit(float(n[i] * mean_y[i])) for j, i in enumerate(of)]
    state = moments.select(
        *fixed, *[F.lit(0.0).alias(c) for c in names("w")], *[s.alias(c) for s, c in zip(start, names("r"))],
        *[(s / z).alias(c) for s, z, c in zip(start, scale, names("d"))],
    )
    first = _sums(state, [r * r / z for r, z in zip(map(column, names("r")), scale)] + [m * d for m, d in zip(mean, map(column, names("d")))])
    left, mean_way = first[:count], first[count:]
    enough = TOLERANCE**2 * np.maximum(left, 1e-300)
    for _ in range(STEPS):
        if not (left > enough).any():
            break
        along = found.along(state, names("d"))
        seen = found.rows.select("pid", *[found.outside("n", f).alias(f"c{i}") for i, f in dict((i, f) for i, f, _ in systems).items()])
        met = found.entries.join(along.join(seen, "pid"), "pid")
        back = met.groupBy("place").agg(*[F.sum(column("x") * column(f"c{i}") * column(d)).alias(f"b{j}") for j, (i, d) in enumerate(zip(of, names("d")))])
        product = [
            F.coalesce(column(f"b{j}"), F.lit(0.0)) - F.lit(float(n[i] * mean_way[j])) * mean[j] + F.lit(a) * column(f"d{j}")
            for j, (i, _, a) in enumerate(systems)
        ]
        state = materialize(state.join(back, "place", "left").select(*state.columns, *[p.alias(c) for p, c in zip(product, names("p"))]), "vectors")
        way = _sums(state, [column(d) * column(p) for d, p in zip(names("d"), names("p"))])
        step = np.where(left > enough, left / np.maximum(way, 1e-300), 0.0)
        rest = [column(r) - F.lit(float(s)) * column(p) for r, p, s in zip(names("r"), names("p"), step)]
        now = _sums(state, [r * r / z for r, z in zip(rest, scale)] + [m * r / z for m, r, z in zip(mean, rest, scale)])
        turn = now[:count] / np.maximum(left, 1e-300)
        state = state.select(
            *fixed, *[(column(w) + F.lit(float(s)) * column(d)).alias(w) for w, d, s in zip(names("w"), names("d"), step)],
            *[r.alias(c) for r, c in zip(rest, names("r"))],
            *[(r / z + F.lit(float(t)) * column(d)).alias(d) for r, z, t, d in zip(rest, scale, turn, names("d"))],
        )
        left, mean_way = now[:count], now[count:] + turn * mean_way
    table = materialize(state.select("place", *fixed[1:], *names("w")), "weights")
    shift = _sums(table, [m * column(w) for m, w in zip(mean, names("w"))])
    return [WideFit(table, w, width, float(mean_y[i] - s)) for w, i, s in zip(names("w"), of, shift)]


def _fits(found: Patterns, width: int, alphas: Sequence[float], held: Sequence[int | None]) -> dict[tuple[int | None, float], WideFit]:
    n = np.array([sum(v for f, v in found.n.items() if f != i) for i in held], float)
    mean_y = np.array([sum(v for f, v in found.total.items() if f != i) for i in held]) / np.maximum(n, 1)
    if np.isnan(list(found.total.values())).any():  # with a label missing, no fit is a number
        mean_y = np.full(len(held), np.nan)
    sides = found.rows.select("pid", *[found.outside(c, f).alias(f"{c}{i}") for i, f in enumerate(held) for c in "ns"])
    x = F.col("x")
    sums = found.entries.join(sides, "pid").groupBy("place").agg(*[c for i in range(len(held)) for c in (
        (F.sum(x * F.col(f"n{i}")) / F.lit(max(n[i], 1.0))).alias(f"m{i}"), F.sum(x * x * F.col(f"n{i}")).alias(f"q{i}"), F.sum(x * F.col(f"s{i}")).alias(f"t{i}"))])
    moments = materialize(sums, "moments")
    systems = [(i, f, float(a)) for i, f in enumerate(held) for a in alphas]
    out = {}
    for a in range(0, len(systems), TOGETHER):
        some = systems[a : a + TOGETHER]
        out.update({(f, alpha): fit for (_, f, alpha), fit in zip(some, _solved(found, moments, some, n, mean_y, width))})
    return out


def wide_fits(
    df: DataFrame, width: int, alphas: Sequence[float], held: Sequence[int | None], features: str = "features", y: str = "y", fold: str = "fold",
) -> tuple[Patterns, dict[tuple[int | None, float], WideFit]]:
    """(the different rows, {(fold left out or None, alpha): fit})."""
    found = patterns(df, features, y, fold)
    return found, _fits(found, width, alphas, held)


def wide_ridge_cv(
    df: DataFrame, width: int, alphas: Sequence[float], k: int = 5, features: str = "features", y: str = "y", fold: str = "fold",
) -> DataFrame:
    """(alpha, fold, rmse) of ridge on sparse rows."""
    found, fits = wide_fits(df, width, alphas, range(k), features, y, fold)
    rows = []
    wanted = [(f, float(a)) for f in found.folds for a in alphas if (f, float(a)) in fits]
    for a in range(0, len(wanted), TOGETHER):
        some = wanted[a : a + TOGETHER]
        tables = {id(fits[s].table): fits[s].table for s in some}
        errors = found.rows
        for t, table in enumerate(tables.values()):
            own = [(j, fits[s].column) for j, s in enumerate(some) if fits[s].table is table]
            scored = found.along(table.select("place", *[F.col(c).alias(f"o{j}") for j, c in own]), [f"o{j}" for j, _ in own])
            errors = errors.join(scored, "pid", "left")
        parts = []
        for j, s in enumerate(some):
            i = found.folds.index(s[0])
            number = F.col(f"n{i}")
            gap = F.col(f"s{i}") / number - F.lit(fits[s].intercept) - F.coalesce(F.col(f"o{j}"), F.lit(0.0))
            parts.append(F.when(number > 0, number * (F.col(f"v{i}") + gap * gap)))
        rows += [(s[1], s[0], float(np.sqrt(e / max(found.n[s[0]], 1)))) for s, e in zip(some, _sums(errors, parts))]
    return df.sparkSession.createDataFrame(rows, "alpha double, fold int, rmse double")
