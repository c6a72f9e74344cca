"""Attribution of tree ensembles: Shapley values per row and feature.

A leaf pays its value to the rows that meet all conditions on its path. Which conditions a row meets is a small bit
pattern, and the Shapley values of a leaf depend on that pattern only. So leaves with the same number of conditions
are packed into arrays, their values per pattern are computed once for all of them, and a row needs comparisons and
look-ups, for all leaves of an array at once.

``path_tree``: a condition that is not known is met with the share of training rows that went that way. ``background``: it
is met as in the rows of a background table, averaged over them; the patterns of each leaf among these rows are
counted by Spark, so the whole table can be the background.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial, inf

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.functions import uniform_hash
from gablework.models.ensemble import Ensemble
from gablework.operators.rows import arg_max
from gablework.shared import col

# The tasks get this code with their work, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE_BITS = 6
BACKGROUND_ROWS = 100
CELLS = 1 << 21  # rows x leaves x conditions looked at together


def _swap(a: int, b: int) -> float:
    """Weight of one of ``a`` conditions that only the row meets, against ``b`` that only the other does."""
    return factorial(a - 1) * factorial(b) / factorial(a + b) if a else 0.0


def bits_of(codes: np.ndarray, d: int) -> np.ndarray:
    return ((codes[..., None] >> np.arange(d)) & 1).astype(bool)


def swapped(met: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of each condition in what a leaf pays for a row's pattern against another's."""
    ours, theirs = met & ~other, ~met & other
    a, b = ours.sum(axis=-1), theirs.sum(axis=-1)
    d = met.shape[-1]
    pay = np.array([[_swap(i, j) for j in range(d + 1)] for i in range(d + 1)])
    reachable = (met | other).all(axis=-1)[..., None]
    return reachable * (ours * pay[a, b][..., None] - theirs * pay[b, a][..., None])


@dataclass
class Leaves:
    """Leaves with the same number of conditions: (leaves x conditions) arrays."""

    value: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray
    number: np.ndarray  # of each leaf among all
    table: np.ndarray | None = None  # (leaves, patterns, conditions)
    seen: list[tuple[np.ndarray, np.ndarray]] | None = None  # per leaf the patterns of a background and their shares

    @property
    def d(self) -> int:
        return self.features.shape[1]

    def codes(self, x: np.ndarray, which: slice = slice(None)) -> np.ndarray:
        part = x[:, self.features[which]]
        met = (part > self.low[which]) & (part <= self.high[which])
        return met @ (1 << np.arange(self.d, dtype=np.int64))

    def chunks(self, rows: int) -> Iterator[slice]:
        step = max(1, CELLS // max(1, rows * self.d))
        for a in range(0, len(self.value), step):
            yield slice(a, a + step)

    def from_cover(self, codes: np.ndarray, which: slice | np.ndarray = slice(None)) -> np.ndarray:
        """(leaves, patterns, conditions) for pattern codes (of all leaves, or leaves x patterns)."""
        met, cover, d = bits_of(codes, self.d).astype(float), self.cover[which][:, None, :], self.d
        met = np.broadcast_to(met, (cover.shape[0], *met.shape[-2:]))
        weight = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
        out = np.empty(met.shape)
        for i in range(d):
            poly = np.zeros(met.shape)  # coefficients by number of known conditions among the others
            poly[..., 0] = 1.0
            for j in range(d):
                if j != i:
                    poly[..., 1:] = poly[..., 1:] * cover[..., j, None] + poly[..., :-1] * met[..., j, None]
                    poly[..., 0] *= cover[..., j]
            out[..., i] = (met[..., i] - cover[..., i]) * (poly @ weight)
        return out * self.value[which][:, None, None]

    def from_seen(self, leaf: int, codes: np.ndarray) -> np.ndarray:
        """(patterns, conditions) of one leaf against the background."""
        others, share = self.seen[leaf]
        out = np.zeros((len(codes), self.d))
        met = bits_of(codes, self.d)
        for o, s in zip(others, share):
            out += s * swapped(met, bits_of(np.asarray(o), self.d))
        return out * self.value[leaf]

    def tabled(self) -> None:
        if self.d > TABLE_BITS:
            return
        codes = np.arange(1 << self.d)
        if self.seen is None:
            self.table = np.concatenate([self.from_cover(codes, w) for w in self.chunks(len(codes))])
            return
        pairs = swapped(bits_of(codes, self.d)[:, None], bits_of(codes, self.d)[None])
        share = np.zeros((len(self.value), len(codes)))
        for row, (c, s) in zip(share, self.seen):
            row[c] = s
        self.table = np.einsum("lo,cod->lcd", share, pairs) * self.value[:, None, None]

    def add_to(self, total: np.ndarray, x: np.ndarray) -> None:
        for which in self.chunks(len(x)):
            codes = self.codes(x, which)
            if self.table is not None:
                paid = self.table[which][np.arange(codes.shape[1]), codes]
            else:
                paid = np.empty((*codes.shape, self.d))
                for i in range(codes.shape[1]):
                    met, place = np.unique(codes[:, i], return_inverse=True)
                    leaf = which.start + i
                    by_pattern = self.from_cover(met, slice(leaf, leaf + 1))[0] if self.seen is None else self.from_seen(leaf, met)
                    paid[:, i] = by_pattern[place]
            to = self.features[which].ravel()
            order = np.argsort(to, kind="stable")
            there, starts = np.unique(to[order], return_index=True)
            total[:, there] += np.add.reduceat(paid.reshape(len(x), -1)[:, order], starts, axis=1)


def leaves_of(fit: Ensemble) -> tuple[list[Leaves], float]:
    """(leaves by number of conditions, what rows are paid without any condition)."""
    constant, found, number = fit.base, {}, 0
    for t in fit.trees:
        scale = 1 / len(fit.trees) if fit.how == "mean" else 1.0
        todo: list[tuple[int, dict]] = [(0, {})]
        while todo:
            at, bounds = todo.pop()
            if t.feature[at] < 0:
                if bounds:
                    found.setdefault(len(bounds), []).append((scale * t.value[at], list(bounds), *zip(*bounds.values()), number))
                    number += 1
                else:
                    constant += scale * t.value[at]
                continue
            f, cut = int(t.feature[at]), float(t.threshold[at])
            low, high, cover = bounds.get(f, (-inf, inf, 1.0))
            for child, side in ((t.left[at], (low, min(high, cut))), (t.right[at], (max(low, cut), high))):
                todo.append((int(child), {**bounds, f: (*side, cover * t.cover[child] / t.cover[at])}))
    return [Leaves(*(np.array(c) for c in zip(*rows))) for _, rows in sorted(found.items())], constant


def background_sample(df: DataFrame, features: Sequence[str], key: str, rows: int = BACKGROUND_ROWS, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``rows`` rows, where a smaller background is wanted than the table."""
    picked = df.select(uniform_hash(F.lit(seed), col(key)).alias("__u"), col(key).alias("__k"), *[col(c) for c in features])
    return picked.orderBy("__u", "__k").limit(rows).select(*[col(c) for c in features])


def numbers(df: DataFrame, fit: Ensemble, carried: Sequence[str] = ()) -> DataFrame:
    return df.select(*[col(c) for c in carried], *[col(c).cast("double").alias(f"__f{i}") for i, c in enumerate(fit.features)])


def matrix(batch: pa.RecordBatch, skip: int = 0) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[skip:]])


def seen_patterns(background: DataFrame, fit: Ensemble, groups: list[Leaves]) -> None:
    """Counts, for every leaf, the patterns of the background's rows; only (leaf, pattern, share) comes to the driver."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray | dict[int, int]] = {}
        for batch in batches:
            x = matrix(batch)
            for g, leaves in enumerate(groups):
                for which in leaves.chunks(len(x)):
                    codes = leaves.codes(x, which)
                    if leaves.d <= TABLE_BITS:
                        size = 1 << leaves.d
                        flat = np.bincount((codes + np.arange(codes.shape[1]) * size).ravel(), minlength=codes.shape[1] * size)
                        key = (g, which.start)
                        counts[key] = counts.get(key, 0) + flat
                    else:
                        for i in range(codes.shape[1]):
                            own = counts.setdefault((g, -1 - which.start - i), {})
                            for c, n in zip(*(v.tolist() for v in np.unique(codes[:, i], return_counts=True))):
                                own[c] = own.get(c, 0) + n
        for (g, at), found in counts.items():
            if at >= 0:
                flat = np.flatnonzero(found)
                leaf, code, n = at + (flat >> groups[g].d), flat & ((1 << groups[g].d) - 1), found[flat]
            else:
                leaf, code, n = np.full(len(found), -1 - at), np.array(list(found)), np.array(list(found.values()))
            yield pa.RecordBatch.from_pydict({
                "leaf": pa.array(groups[g].number[leaf].astype(np.int32)), "code": pa.array(code.astype(np.int64)), "n": pa.array(n.astype(np.int64)),
            })

    # a chunk's place depends on the batch size, so the counts of one task may come in several pieces
    parts = numbers(background, fit).mapInArrow(read, "leaf int, code long, n long")
    by_leaf: dict[int, tuple[list[int], list[int]]] = {}
    for r in parts.groupBy("leaf", "code").agg(F.sum("n").alias("n")).collect():
        codes, n = by_leaf.setdefault(r["leaf"], ([], []))
        codes.append(r["code"])
        n.append(r["n"])
    for leaves in groups:
        leaves.seen = []
        for i in leaves.number.tolist():
            codes, n = by_leaf.get(i, ([], []))
            leaves.seen.append((np.array(codes, np.int64), np.array(n, float) / max(sum(n), 1)))


def tree_attributions(
    df: DataFrame, fit: Ensemble, key: str, keep: Sequence[str] = (), background: DataFrame | None = None
) -> DataFrame:
    """(key, keep..., base, contributions) for every row; one narrow pass, no shuffle.

    Contributions come in the order of ``fit.features``; base + sum = prediction. Without ``background`` the training
    shares stored in the trees are used; a background is read once more, whole.
    """
    groups, base = leaves_of(fit)
    if background is not None:
        seen_patterns(background, fit, groups)
    for leaves in groups:
        if leaves.seen is None:
            base += float(leaves.value @ leaves.cover.prod(axis=1))
        else:
            full = (1 << leaves.d) - 1
            base += sum(float(v * s[c == full].sum()) for v, (c, s) in zip(leaves.value, leaves.seen))
        leaves.tabled()
    width, carried = len(fit.features), [key, *keep]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch.iloc[:, len(carried):].to_numpy(dtype=float)
            total = np.zeros((len(batch), width))
            for leaves in groups:
                leaves.add_to(total, x)
            out = batch.iloc[:, : len(carried)].copy()
            out["base"] = base
            out["contributions"] = list(total)
            yield out

    schema = T.StructType(
        [df.schema[c] for c in carried]
        + [T.StructField("base", T.DoubleType()), T.StructField("contributions", T.ArrayType(T.DoubleType()))]
    )
    return numbers(df, fit, carried).mapInPandas(explain, schema)


def explained_row(df: DataFrame, fit: Ensemble, key: str, y: str, background: DataFrame | None = None) -> DataFrame:
    """``tree_attributions`` of the row with the largest ``y`` alone; the table is read for that row and as background only."""
    return tree_attributions(arg_max(df, y, key), fit, key, [*fit.features, y], background)
