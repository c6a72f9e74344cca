"""Tree ensembles grown from histograms, any number of them side by side.

The features are binned once. To grow one level of all trees that are open, each task adds up, per (tree, node,
feature, bin), the sums of residuals, weights and rows of its part of the table; the sums are grouped by node and the best
split of every node is all that reaches the driver. Folds, trials, styles and the trees of a forest share these
passes: ensembles differ only in which rows they learn from and how a split is judged.

Where many rows have the same bins (``Table.crowded``, by the approximate number of distinct ones), the table is written
sorted by them. One pass a round then adds up each tree's residuals and weights per distinct row of bins, and the levels are
grown from these sums: a tree sends rows with the same bins the same way. The sums are whole numbers, so both ways
give the same trees. Other tables are read once a level.

Ensembles of many rounds, over a table with few distinct rows of bins (``Grower._known``), are grown without a pass a level: the driver
keeps the predictions per distinct row of bins. A table that a task can hold is sent to the tasks, each of which grows whole ensembles; of a larger
crowded one, the sums of a round are dealt out by tree, and a task grows the whole tree. The trees are the same.

Residuals are rounded to a fixed unit (2**-30 of the largest label), so that sums are exact and the trees do not depend on
how the rows are dealt out. Rows and columns are sampled by hash. Predictions so far are written with the rows
every ``WRITE_EVERY`` rounds.

Leaf-wise growth: as the gain of a node does not depend on other nodes, all levels are grown first and the best-first order
is replayed on the gains.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.models.ensemble import Ensemble, Tree
from gablework.operators.quantile import quantiles
from gablework.shared import col, materialize

# The tasks get this code with their work, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 255
WRITE_EVERY = 20
LEAST_GAIN = 1e-10
DENSE_CELLS = 1 << 22  # sums that a task holds before it hands them on
ROW_BLOCK = 1 << 16
CROWD = 8  # rows of a distinct row of bins, from which on they are added up first
SLICE = 4096  # rows of a batch that a task hands on
PASSES = 64  # levels that are grown with a pass each; where there are more, whole trees or ensembles are grown in a task
HELD_ROWS = 1 << 20  # rows of a table that a task may hold
HELD_CELLS = 1 << 18  # distinct rows of bins that a task may hold
HELD_BYTES = 64 << 20  # predictions of all plans for them, which the driver hands to the tasks
FOREST_PART = 25  # trees of a forest that a task grows
CELLS = "__bins binary, __sums binary"
SUMS = "slot int, node int, feature int, bin int, g double, h double, n double"
SPLITS = "slot int, node int, feature int, bin int, gain double, gl double, hl double, nl double, g double, h double, n double"
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])  # how often a bootstrap takes a row


@dataclass(frozen=True)
class Plan:
    """One ensemble to grow. ``held``: (fold column, fold) pairs whose rows it must not see."""

    name: str
    style: str  # "depth", "leaf" or "forest"
    trees: int
    depth: int
    rate: float = 1.0
    leaves: int = 0  # most leaves of a tree, leaf-wise only
    least_rows: int = 1
    least_weight: float = 0.0
    least_split: int = 2
    l1: float = 0.0
    l2: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42
    held: tuple[tuple[str, int], ...] = ()


def multiplier(seed: int, tree: int) -> int:
    """Spreads a row's 32-bit hash anew for each tree."""
    return int(hashlib.md5(f"{seed}:{tree}".encode()).hexdigest()[:8], 16) | 1


def columns_of(plan: Plan, tree: int, features: int) -> list[int]:
    """The features that a tree may use."""
    order = sorted(range(features), key=lambda j: hashlib.md5(f"{plan.seed}:{tree}:{j}".encode()).hexdigest())
    return sorted(order[: max(1, int(plan.column_share * features + 1e-9))])


def uniform(h: np.ndarray, seed: int, tree: int) -> np.ndarray:
    spread = (h.astype(np.uint64) * np.uint64(multiplier(seed, tree))) & np.uint64(0xFFFFFFFF)
    return spread.astype(np.float64) / 2.0**32


def weights(plan: Plan, tree: int, h: np.ndarray) -> np.ndarray:
    """How often the tree takes each row."""
    if plan.style == "forest":
        return np.searchsorted(POISSON, uniform(h, plan.seed, tree), side="right").astype(np.float64)
    if plan.row_share < 1:
        return (uniform(h, plan.seed, tree) < plan.row_share).astype(np.float64)
    return np.ones(len(h))


# Bins

def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the upper ends of its bins: halfway between values where they are few, else equally spaced quantiles.

    Tasks hand on at most ``bins`` + 1 values a feature; with more, quantiles decide."""
    width = len(features)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0) for _ in range(width)]
        for batch in batches:
            for i in range(width):
                if len(seen[i]) <= bins:
                    seen[i] = np.union1d(seen[i], batch.column(i).to_numpy(zero_copy_only=False))[: bins + 1]
        for i, v in enumerate(seen):
            yield pa.RecordBatch.from_pydict({"feature": pa.array([i] * len(v), pa.int32()), "value": pa.array(v, pa.float64())})

    numbers = df.select(*[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)])
    found = materialize(numbers.mapInArrow(read, "feature int, value double").distinct(), "values")
    few = {r["feature"] for r in found.groupBy("feature").count().where(F.col("count") <= bins).collect()}
    values: dict[int, list[float]] = {i: [] for i in few}
    for r in found.where(F.col("feature").isin(list(few))).collect() if few else ():
        values[r["feature"]].append(r["value"])
    edges = [np.zeros(0)] * width
    for i, v in values.items():
        v = np.sort(v)
        edges[i] = (v[:-1] + v[1:]) / 2
    many = [c for i, c in enumerate(features) if i not in few]
    if many and found.take(1):
        for r in quantiles(df, many, [i / bins for i in range(1, bins)]).collect():
            edges[features.index(r["column"])] = np.unique(r["quantiles"])
    return edges


@dataclass
class Table:
    """Binned rows: carried columns, bins, y, h, folds and the predictions so far."""

    rows: DataFrame
    edges: list[np.ndarray]
    folds: list[str]
    unit: float
    crowded: bool = False
    count: int = 0
    different: int = 0  # rows of bins, approximately
    known: Broadcast | None = None  # key of each distinct row of bins, in order, and its predictions so far by plan

    def read(self) -> DataFrame:
        """What growing needs of the rows."""
        return self.rows.select(*[c for c in self.rows.columns if not c.startswith("__c")])


def binned(
    df: DataFrame, features: Sequence[str], y: str, key: str | None, folds: Sequence[str], carry: Sequence[str], bins: int = BINS,
) -> Table:
    """Written once. Missing values are an error."""
    features = list(features)
    needed = [*features, y, *folds]
    first = df.agg(
        F.max(F.abs(col(y).cast("double"))).alias("top"), F.count(F.lit(1)).alias("rows"),
        *[F.count(F.nanvl(col(c).cast("double"), F.lit(None))).alias(f"n{i}") for i, c in enumerate(needed)],
    ).first()
    gaps = [c for i, c in enumerate(needed) if first[f"n{i}"] < first["rows"]]
    if gaps or not first["rows"]:
        raise ValueError(f"missing values in {gaps}" if gaps else "no rows to learn from")
    edges = bin_edges(df, features, bins)
    unit = 2.0 ** (math.ceil(math.log2(first["top"] or 1.0)) - 30)
    name = col(key).cast("string") if key else F.concat_ws(":", *[col(c).cast("string") for c in [*features, y]])
    h = F.conv(F.substring(F.md5(F.concat(F.lit("rows:"), name).cast("binary")), 1, 8), 16, 10).cast("long")
    wide = df.select(
        *[col(c).alias(f"__c{i}") for i, c in enumerate(carry)], *[col(c).cast("int").alias(f"__f{i}") for i, c in enumerate(folds)],
        col(y).cast("double").alias("__y"), h.alias("__h"), *[col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(features)],
    )
    kept = wide.columns[: len(wide.columns) - len(features)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(edges)), np.uint16)
            for i, e in enumerate(edges):
                x[:, i] = np.searchsorted(e, b.column(len(kept) + i).to_numpy(zero_copy_only=False), side="left")
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * len(edges)), b.num_rows, [None, pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], fixed.cast(pa.binary())], [*kept, "__bins"])

    schema = wide.select(*kept).withColumn("__bins", F.lit(None).cast("binary")).schema
    rows = materialize(wide.mapInArrow(read, schema), "binned")
    different = rows.agg(F.approx_count_distinct("__bins")).first()[0]
    crowded = first["rows"] >= CROWD * different
    if crowded:  # rebalanced, as one row of bins may have any share of the rows
        rows = materialize(rows.hint("rebalance", F.col("__bins")).sortWithinPartitions("__bins"), "sorted")
    return Table(rows, edges, list(folds), unit, crowded, first["rows"], different)


def bins_of(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """The bins of the rows, all of one width."""
    a = column.combine_chunks()
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    ends = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + rows + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint16).reshape(rows, -1)


def strides_of(edges: Sequence[np.ndarray]) -> list[int]:
    """What each feature's bin counts in the key of a row of bins."""
    out = [1]
    for e in reversed(edges[1:]):
        out.append(out[-1] * (len(e) + 1))
    return out[::-1]


def keys_of(bins: np.ndarray, strides: Sequence[int]) -> np.ndarray:
    return bins.astype(np.int64) @ np.array(strides, np.int64)


class Part:
    """One block of rows in a task. ``starts``: where the bins differ from those of the row before. ``known``: keys and predictions of
    distinct rows of bins."""

    def __init__(self, batches: Sequence[pa.RecordBatch], folds: Sequence[str], unit: float, known: tuple | None = None, strides: Sequence[int] = ()):
        t = pa.Table.from_batches(batches)
        self.y, self.h = (t.column(c).to_numpy() for c in ("__y", "__h"))
        self.bins = bins_of(t.column("__bins"), len(self.y))
        self.folds = {c: t.column(f"__f{i}").to_numpy() for i, c in enumerate(folds)}
        self.sums = t.column("__p").combine_chunks().flatten().to_numpy().reshape(len(self.y), -1) if "__p" in t.column_names else None
        self.unit = unit
        new = np.append(True, (self.bins[1:] != self.bins[:-1]).any(axis=1))
        self.starts = np.flatnonzero(new)
        self.run = np.cumsum(new) - 1
        self.distinct = self.bins[self.starts]
        self.known = known[1][:, np.searchsorted(known[0], keys_of(self.distinct, strides))] if known else None
        self._sees: dict[tuple, np.ndarray] = {}
        self._weights: dict[tuple, np.ndarray] = {}

    def sees(self, plan: Plan) -> np.ndarray:
        if plan.held not in self._sees:
            out = np.ones(len(self.y), bool)
            for c, f in plan.held:
                out &= self.folds[c] != f
            self._sees[plan.held] = out
        return self._sees[plan.held]

    def weights(self, plan: Plan, tree: int) -> np.ndarray:
        """Of the rows that the plan sees; the draw is shared by plans that differ in other things."""
        draw = ("forest", plan.seed, tree) if plan.style == "forest" else (plan.row_share, plan.seed, tree) if plan.row_share < 1 else ()
        if draw not in self._weights:
            self._weights[draw] = weights(plan, tree, self.h)
        return self._weights[draw] * self.sees(plan)

    def whole(self, v: np.ndarray) -> np.ndarray:
        return np.floor(v / self.unit + 0.5)

    def predicted(self, i: int, base: float, trees: Sequence[Tree]) -> np.ndarray:
        """Of a boosted ensemble, from the written sums and the trees since."""
        if self.known is not None:
            return self.known[i][self.run]
        out = np.full(len(self.starts), base) if self.sums is None else self.sums[self.starts, i]
        for t in trees:
            out += t.value[t.places(self.distinct)]
        return out[self.run]

    def residuals(self, plan: Plan, i: int, base: float, trees: Sequence[Tree]) -> np.ndarray:
        return self.whole(self.y - (base if plan.style == "forest" else self.predicted(i, base, trees)))


class Cells:
    """One block of sums per distinct row of bins: of each slot, of residuals, weights and rows."""

    def __init__(self, batches: Sequence[pa.RecordBatch]):
        t = pa.Table.from_batches(batches)
        self.bins = bins_of(t.column("__bins"), t.num_rows)
        self.sums = np.frombuffer(bins_of(t.column("__sums"), t.num_rows).tobytes(), np.float64).reshape(t.num_rows, -1, 3)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= ROW_BLOCK:
            yield held
            held, rows = [], 0
    if rows:
        yield held


# Growing

@dataclass
class Open:
    """A tree that is being grown, in bins."""

    plan: int
    tree: int
    columns: list[int]
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[tuple[float, float, float]] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])
    frontier: list[int] = field(default_factory=lambda: [0])
    depth: int = 0

    def split(self, plan: Plan, found: dict[int, tuple]) -> None:
        """One level further: the best split of each open node, if it has one."""
        frontier = []
        for node in self.frontier:
            if node not in found:
                continue
            feature, cut, gain, gl, hl, nl, g, h, n = found[node]
            if node == 0:
                self.stats[0] = (g, h, n)
            if feature < 0:
                continue
            self.feature[node], self.bin[node], self.gain[node] = feature, cut, gain
            for side, stats in (("left", (gl, hl, nl)), ("right", (g - gl, h - hl, n - nl))):
                child = len(self.feature)
                getattr(self, side)[node] = child
                for values, new in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.gain, 0.0), (self.stats, stats)):
                    values.append(new)
                frontier.append(child)
        self.depth += 1
        self.frontier = frontier if self.depth < plan.depth else []

    def best_first(self, leaves: int) -> None:
        """Keeps the splits that best-first growth makes until there are ``leaves`` leaves."""
        chosen, queue = set(), [(-self.gain[0], 0)] if self.feature[0] >= 0 else []
        while queue and len(chosen) < leaves - 1:
            _, node = heapq.heappop(queue)
            chosen.add(node)
            for child in (self.left[node], self.right[node]):
                if self.feature[child] >= 0:
                    heapq.heappush(queue, (-self.gain[child], child))
        for node in range(len(self.feature)):
            if node not in chosen:
                self.feature[node] = -1

    def values(self, plan: Plan, unit: float, base: float) -> np.ndarray:
        g, h, _ = np.array(self.stats).T
        value = np.sign(g) * np.maximum(np.abs(g) - plan.l1 / unit, 0.0) / np.maximum(h + plan.l2, 1e-300) * unit
        return base + value if plan.style == "forest" else plan.rate * value

    def grow(self, plan: Plan, bins: np.ndarray, widths: Sequence[int], g: np.ndarray, h: np.ndarray, n: np.ndarray, unit: float) -> np.ndarray:
        """All levels at once from sums per distinct row of bins (``bins``: by feature). Gives the node that each comes to."""
        at, rows = np.zeros(len(g), np.int64), np.arange(len(g))
        live = np.flatnonzero(h > 0)
        sums = [g[live], h[live], h[live] if n is h else n[live]]
        lows = {f: bins[f][live].astype(np.int64) for f in self.columns}
        while self.frontier:
            first, k = self.frontier[0], len(self.frontier)
            rank = at[live] - first
            here = np.flatnonzero(rank >= 0)  # the open nodes are the last ones
            rank = rank[here]
            parts = [sums[0][here], sums[1][here]]
            parts.append(parts[1] if sums[2] is sums[1] else sums[2][here])
            best: list[tuple | None] = [None] * k
            for f in self.columns:
                gain, cut, *stats = best_cuts(rank, k, lows[f][here], widths[f], parts, plan, unit)
                for i, (v, c, *st) in enumerate(zip(gain.tolist(), cut.tolist(), *(x.tolist() for x in stats))):
                    if best[i] is None or v > best[i][2]:
                        best[i] = (f if v >= 0 else -1, c, v, *st)
            before = len(self.feature)
            self.split(plan, {first + i: b for i, b in enumerate(best)})
            if len(self.feature) > before:
                feature, cut = np.array(self.feature), np.array(self.bin)
                inner = feature >= 0
                inner[before:] = False
                to = np.where(inner, self.left, np.arange(len(feature)))
                feature, cut = np.where(inner, feature, 0), np.where(inner, cut, 1 << 16)
                at = to[at] + (bins[feature[at], rows] > cut[at])  # the right child follows the left one
        if plan.leaves:
            self.best_first(plan.leaves)
            at = self.ends()[at]
        return at

    def ends(self) -> np.ndarray:
        """The node at which a row stops that would have come to each node before splits were taken back."""
        out = np.arange(len(self.feature))
        for node, (f, left, right) in enumerate(zip(self.feature, self.left, self.right)):
            if f < 0 and left:
                out[left] = out[right] = out[node]
        return out

    def closed(self, plan: Plan, edges: Sequence[np.ndarray], unit: float, base: float) -> Tree:
        if plan.leaves:
            self.best_first(plan.leaves)
        keep, order = {0: 0}, [0]
        for node in order:
            if self.feature[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    keep[child] = len(order)
                    order.append(child)
        feature = np.array([self.feature[i] for i in order], np.int32)
        inner = feature >= 0
        h, value = np.array([self.stats[i][1] for i in order]), self.values(plan, unit, base)[order]
        return Tree(
            feature=feature, bin=np.array([self.bin[i] for i in order], np.int32),
            threshold=np.array([edges[self.feature[i]][self.bin[i]] if self.feature[i] >= 0 else np.inf for i in order]),
            left=np.array([keep[self.left[i]] if k else 0 for i, k in zip(order, inner)], np.int32),
            right=np.array([keep[self.right[i]] if k else 0 for i, k in zip(order, inner)], np.int32),
            value=np.where(inner, 0.0, value), cover=h, gain=np.where(inner, [self.gain[i] for i in order], 0.0), depth=self.depth,
        )

    def so_far(self) -> Tree:
        ints = [np.array(v, np.int32) for v in (self.feature, self.bin, self.left, self.right)]
        return Tree(ints[0], ints[1], np.zeros(0), ints[2], ints[3], np.zeros(0), np.zeros(0), np.zeros(0), self.depth)


def cell_sums(table: Table, plans: Sequence[Plan], bases: Sequence[float], since: Sequence[Sequence[Tree]], trees: Sequence[Open]) -> DataFrame:
    """Sums per row of bins, for every tree that is about to be grown."""
    folds, unit, known, strides = table.folds, table.unit, table.known, strides_of(table.edges)
    numbers = [(t.plan, t.tree) for t in trees]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            part, residuals = Part(block, folds, unit, known.value if known else None, strides), {}
            out = np.empty((len(part.starts), len(numbers), 3))
            for slot, (p, number) in enumerate(numbers):
                if p not in residuals:
                    residuals[p] = part.residuals(plans[p], p, bases[p], since[p])
                w = part.weights(plans[p], number)
                for i, v in enumerate((residuals[p] * w, w, (w > 0).astype(np.float64))):
                    out[:, slot, i] = np.add.reduceat(v, part.starts)
            for a in range(0, len(out), SLICE):
                columns = [(v[a : a + SLICE], v[0].nbytes) for v in (part.distinct, out)]
                yield pa.RecordBatch.from_arrays([
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(v), [None, pa.py_buffer(v.tobytes())]).cast(pa.binary()) for v, n in columns
                ], ["__bins", "__sums"])

    return table.read().mapInArrow(read, CELLS)


def histograms(
    table: Table, plans: Sequence[Plan], bases: Sequence[float], since: Sequence[Sequence[Tree]], trees: Sequence[Open],
    cells: DataFrame | None = None, places: Sequence[int] = (),
) -> DataFrame:
    """Sums per (slot, node, feature, bin) of all open trees; a slot is a tree's number in ``trees``.

    ``cells``: sums that were added up before, in which the trees have the numbers ``places``."""
    folds, unit = table.folds, table.unit
    width = max((len(e) for e in table.edges), default=0) + 1
    shapes = [(t.plan, t.tree, t.columns, t.so_far(), np.array(t.frontier)) for t in trees]
    summed = cells is not None

    def weighted(block: Sequence[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Bins, nodes, and sums of residuals, weights and rows, of each slot."""
        if summed:
            part = Cells(block)
            for slot, (_, _, _, shape, _) in enumerate(shapes):
                g, h, n = part.sums[:, places[slot]].T
                yield part.bins, shape.places(part.bins), g, h, n
            return
        part, residuals = Part(block, folds, unit), {}
        for p, number, _, shape, _ in shapes:
            if p not in residuals:
                residuals[p] = part.residuals(plans[p], p, bases[p], since[p])
            w = part.weights(plans[p], number)
            yield part.bins, shape.places(part.distinct)[part.run], residuals[p] * w, w, (w > 0).astype(np.float64)

    def sums(block: Sequence[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for slot, (bins, place, g, h, n) in enumerate(weighted(block)):
            columns, shape, frontier = shapes[slot][2:]
            rank = np.full(len(shape.feature), -1)
            rank[frontier] = np.arange(len(frontier))
            place = rank[place]
            rows = np.flatnonzero((place >= 0) & (h > 0))
            place, g, h, n = place[rows], g[rows], h[rows], n[rows]
            for f in columns:
                at = place * width + bins[rows, f]
                if len(frontier) * width <= max(4 * len(rows), 1 << 16):
                    all_n = np.bincount(at, n)
                    cell = np.flatnonzero(all_n)
                    parts = np.bincount(at, g)[cell], np.bincount(at, h)[cell], all_n[cell]
                else:
                    cell, inverse = np.unique(at, return_inverse=True)
                    parts = tuple(np.bincount(inverse, v, len(cell)) for v in (g, h, n))
                yield slot, f, frontier[cell // width], cell % width, *parts

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple]] = {}
        size = 0
        for block in blocks(batches):
            for slot, f, *columns in sums(block):
                held.setdefault((slot, f), []).append(columns)
                size += len(columns[0])
            if size > DENSE_CELLS:
                yield from added(held, width)
                held, size = {}, 0
        yield from added(held, width)

    return (cells if summed else table.read()).mapInArrow(read, SUMS)


def added(held: dict[tuple[int, int], list[tuple]], width: int) -> Iterator[pa.RecordBatch]:
    """The cells of several blocks of rows, added up."""
    for (slot, f), parts in held.items():
        node, bin_, g, h, n = (np.concatenate(c) for c in zip(*parts))
        if len(parts) > 1:
            cell, inverse = np.unique(node.astype(np.int64) * width + bin_, return_inverse=True)
            node, bin_ = cell // width, cell % width
            g, h, n = (np.bincount(inverse, v, len(cell)) for v in (g, h, n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(node), slot, np.int32)), pa.array(node.astype(np.int32)), pa.array(np.full(len(node), f, np.int32)),
             pa.array(bin_.astype(np.int32)), *[pa.array(v.astype(np.float64)) for v in (g, h, n)]], ["slot", "node", "feature", "bin", "g", "h", "n"]
        )


def score(g: np.ndarray, h: np.ndarray, l1: np.ndarray | float, l2: np.ndarray | float) -> np.ndarray:
    t = np.maximum(np.abs(g) - l1, 0.0)
    return t * t / np.maximum(h + l2, 1e-300)


def best_cuts(rank: np.ndarray, k: int, low: np.ndarray, width: int, sums: Sequence[np.ndarray], plan: Plan, unit: float) -> list[np.ndarray]:
    """Of one feature, the first best cut of each of ``k`` nodes: gain (negative: none is allowed), bin, sums below and in all.

    ``sums``: of residuals, weights and rows, of rows of bins in node ``rank`` and bin ``low``."""
    at = rank * width + low
    alike = sums[2] is sums[1]
    if dense := k * width <= 4 * len(at) + 1024:
        parts = [np.bincount(at, v, k * width).reshape(k, width) for v in sums[: 2 if alike else 3]]
        below = [np.cumsum(v, axis=1) for v in parts]
        total = [v[:, -1:] for v in below]
    else:
        order = np.argsort(at, kind="stable")
        cell = at[order]
        heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        cell = cell[heads]
        starts = np.searchsorted(cell, np.arange(k) * width)
        sizes = np.diff(np.append(starts, len(cell)))
        below, total = [], []
        for v in sums[: 2 if alike else 3]:
            v = np.add.reduceat(v[order], heads)
            running = np.cumsum(v)
            below.append(running - np.repeat((running - v)[starts], sizes))
            total.append(np.repeat(np.add.reduceat(v, starts), sizes))
    if alike:
        below.append(below[1])
        total.append(total[1])
    above = [t - b for t, b in zip(total, below)]
    l1 = plan.l1 / unit
    gain = score(below[0], below[1], l1, plan.l2) + score(above[0], above[1], l1, plan.l2) - score(total[0], total[1], l1, plan.l2)
    gain = gain * unit * unit
    ok = (gain > LEAST_GAIN) & (total[2] >= plan.least_split)
    for _, h, n in (below, above):
        ok &= (n >= plan.least_rows) & (h >= plan.least_weight) & (n > 0)
    gain = np.where(ok, gain, -1.0)
    if dense:
        cut = gain.argmax(axis=1)
        pick = (np.arange(k), cut)
        return [gain[pick], cut, *[b[pick] for b in below], *[t[:, 0] for t in total]]
    hits = np.flatnonzero(gain == np.repeat(np.maximum.reduceat(gain, starts), sizes))
    pick = hits[np.searchsorted(hits, starts)]
    return [gain[pick], cell[pick] % width, *[b[pick] for b in below], *[t[pick] for t in total]]


def best_splits(sums: DataFrame, plans: Sequence[Plan], unit: float) -> DataFrame:
    """The best split of every (slot, node); the first feature and bin of equals. Feature -1: none is allowed.

    ``plans``: by slot."""
    rules = np.array([[p.l1 / unit, p.l2, p.least_rows, p.least_weight, p.least_split] for p in plans])

    def best(t: dict[str, np.ndarray]) -> pa.RecordBatch:
        slot, node, feature = t["slot"], t["node"], t["feature"]
        new_node = np.append(True, (slot[1:] != slot[:-1]) | (node[1:] != node[:-1]))
        new = new_node | np.append(True, feature[1:] != feature[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(slot)))
        total, below = {}, {}
        for c in "ghn":
            running = np.cumsum(t[c])
            below[c] = running - np.repeat(running[starts] - t[c][starts], sizes)
            total[c] = np.repeat(np.add.reduceat(t[c], starts), sizes)
        l1, l2, rows, weight, least = rules[slot].T
        gain = score(below["g"], below["h"], l1, l2) + score(total["g"] - below["g"], total["h"] - below["h"], l1, l2) - score(total["g"], total["h"], l1, l2)
        gain = gain * unit * unit
        ok = (gain > LEAST_GAIN) & (total["n"] >= least)
        for n in (below, {c: total[c] - below[c] for c in "ghn"}):
            ok &= (n["n"] >= rows) & (n["h"] >= weight) & (n["n"] > 0)
        gain = np.where(ok, gain, -1.0)
        heads = np.flatnonzero(new_node)
        top = np.repeat(np.maximum.reduceat(gain, heads), np.diff(np.append(heads, len(slot))))
        hits = np.flatnonzero(gain == top)
        group = np.cumsum(new_node)[hits]
        pick = hits[np.append(True, group[1:] != group[:-1])]
        none = gain[pick] < 0
        columns = {
            "slot": slot[pick], "node": node[pick], "feature": np.where(none, -1, feature[pick]), "bin": t["bin"][pick], "gain": gain[pick],
            **{f"{c}l": below[c][pick] for c in "ghn"}, **{c: total[c][pick] for c in "ghn"},
        }
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int32() if c in ("slot", "node", "feature", "bin") else pa.float64()) for c, v in columns.items()})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([*rest, batch])
            slot, node = (t.column(c).to_numpy() for c in ("slot", "node"))
            changes = np.flatnonzero((slot[1:] != slot[:-1]) | (node[1:] != node[:-1]))
            cut = int(changes[-1]) + 1 if len(changes) else 0  # the last node may go on
            if cut:
                yield best({c: t.column(c).to_numpy()[:cut] for c in t.column_names})
            rest = t.slice(cut).to_batches()
        if rest:
            t = pa.Table.from_batches(rest)
            yield best({c: t.column(c).to_numpy() for c in t.column_names})

    dealt = sums.repartition("slot", "node").groupBy("slot", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])
    return dealt.sortWithinPartitions("slot", "node", "feature", "bin").mapInArrow(read, SPLITS)


GROWN = "number int, part binary, trees binary"


def grown_alone(plan: Plan, i: int, base: float, numbers: Sequence[int], data: dict, keep: bool) -> tuple[np.ndarray, list[Tree]]:
    """An ensemble, or some trees of a forest, from a table that the task holds: what is predicted per distinct row of bins, and the trees."""
    y, h, cell, unit, edges = data["y"], data["h"], data["cell"], data["unit"], data["edges"]
    bins, cells = data["bins"], data["bins"].shape[1]
    widths = [len(e) + 1 for e in edges]
    seen = np.ones(len(y), bool)
    for c, f in plan.held:
        seen &= data["folds"][c] != f
    y, h, cell = y[seen], h[seen], cell[seen]
    forest = plan.style == "forest"
    out, trees = np.zeros(cells) if forest else np.full(cells, base), []
    whole = np.bincount(cell, minlength=cells).astype(np.float64)
    fixed = np.floor((y - base) / unit + 0.5)
    for number in numbers:
        tree = Open(i, number, columns_of(plan, number, len(edges)))
        if forest:
            w = weights(plan, number, h)
            g, taken, n = (np.bincount(cell, v, cells) for v in (fixed * w, w, (w > 0).astype(np.float64)))
        elif plan.row_share < 1:
            rows = np.flatnonzero(weights(plan, number, h))
            own = cell[rows]
            g, taken = np.bincount(own, np.floor((y[rows] - out[own]) / unit + 0.5), cells), np.bincount(own, minlength=cells).astype(np.float64)
            n = taken
        else:
            g, taken, n = np.bincount(cell, np.floor((y - out[cell]) / unit + 0.5), cells), whole, whole
        at = tree.grow(plan, bins, widths, g, taken, n, unit)
        value = tree.values(plan, unit, base)[at]
        out += value / plan.trees if forest else value
        if keep:
            trees.append(tree.closed(plan, edges, unit, base))
    return out, trees


class Grower:
    """Grows the ensembles of all plans together."""

    def __init__(self, table: Table, plans: Sequence[Plan]):
        self.table, self.plans = table, list(plans)
        self.bases = self._bases()
        self.done: list[list[Tree]] = [[] for _ in plans]
        self.since: list[list[Tree]] = [[] for _ in plans]
        self.keys: np.ndarray | None = None  # of the distinct rows of bins, if the driver keeps their predictions
        self.found = np.zeros((0, 0))

    def _known(self) -> bool:
        """Whether there are many levels to grow, and few distinct rows of bins to keep predictions for."""
        boosted = [p for p in self.plans if p.style != "forest"]
        forests = [p for p in self.plans if p.style == "forest"]
        passes = max((p.trees for p in boosted), default=0) * max((p.depth for p in boosted), default=0)
        passes += -(-sum(p.trees for p in forests) // 64) * max((p.depth for p in forests), default=0)
        most = min(HELD_CELLS, HELD_BYTES // 8 // max(len(self.plans), 1))
        bits = sum(math.log2(len(e) + 1) for e in self.table.edges)
        if passes <= PASSES or self.table.different > most or bits > 62 or not (self.table.crowded or self.table.count <= HELD_ROWS):
            return False
        rows = self.table.rows.select("__bins").distinct().limit(most + 1).collect()  # the number before was approximate
        if len(rows) > most:
            return False
        bins = np.frombuffer(b"".join(r[0] for r in rows), np.uint16).reshape(len(rows), -1)
        keys = keys_of(bins, strides_of(self.table.edges))
        order = np.argsort(keys)
        self.keys, self.shape = keys[order], self.table.rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(bins[order].T))
        self.found = np.zeros((len(self.plans), len(order)))
        for i, (p, base) in enumerate(zip(self.plans, self.bases)):
            self.found[i] = 0.0 if p.style == "forest" else base
        return True

    def _tell(self) -> None:
        """The predictions so far, for the tasks."""
        if self.table.known:
            self.table.known.unpersist()
        self.table.known = self.table.rows.sparkSession.sparkContext.broadcast((self.keys, self.found))

    def _alone(self, keep: bool) -> None:
        """Every task holds the table and grows ensembles of its own."""
        table, plans, bases = self.table, self.plans, self.bases
        spark = table.rows.sparkSession
        t = table.read().toArrow()
        keys = keys_of(bins_of(t.column("__bins"), t.num_rows), strides_of(table.edges))
        cell = np.searchsorted(self.keys, keys)
        order = np.argsort(cell, kind="stable")
        data = {"y": t.column("__y").to_numpy()[order], "h": t.column("__h").to_numpy()[order], "cell": cell[order], "bins": self.shape.value, "unit": table.unit, "edges": table.edges}
        data["folds"] = {c: t.column(f"__f{i}").to_numpy()[order] for i, c in enumerate(table.folds)}
        work = [(i, list(range(a, min(a + FOREST_PART, p.trees)))) if p.style == "forest" else (i, list(range(p.trees))) for i, p in enumerate(plans)
                for a in (range(0, p.trees, FOREST_PART) if p.style == "forest" else [0])]
        work.sort(key=lambda w: -len(w[1]) * plans[w[0]].depth * (4 if plans[w[0]].style == "forest" else 1))  # the longest first
        said = spark.sparkContext.broadcast(data)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for number in b.column(0).to_pylist():
                    i, numbers = work[number]
                    out, trees = grown_alone(plans[i], i, bases[i], numbers, said.value, keep)
                    yield pa.RecordBatch.from_pydict({
                        "number": pa.array([number], pa.int32()), "part": pa.array([out.tobytes()], pa.binary()), "trees": pa.array([cloudpickle.dumps(trees)], pa.binary()),
                    })

        grown = spark.range(0, len(work), 1, len(work)).mapInArrow(read, GROWN).collect() if work else []
        for r in sorted(grown, key=lambda r: (work[r["number"]][0], work[r["number"]][1][:1])):
            i, part = work[r["number"]][0], np.frombuffer(r["part"])
            self.found[i] = self.found[i] + part if plans[i].style == "forest" else part
            self.done[i] += cloudpickle.loads(r["trees"])
        said.unpersist()

    def _whole_trees(self, trees: list[Open], keep: bool) -> None:
        """One round: the sums per row of bins are dealt out by tree."""
        self._tell()
        table, plans, bases, known = self.table, self.plans, self.bases, self.table.known
        unit, edges, strides, shape, cells = table.unit, table.edges, strides_of(table.edges), self.shape, len(self.keys)
        numbers = [(t.plan, t.tree, t.columns) for t in trees]
        widths = [len(e) + 1 for e in edges]

        def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in batches:
                if block.num_rows:
                    part = Cells([block])
                    place = np.searchsorted(known.value[0], keys_of(part.bins, strides)).tobytes()
                    yield pa.RecordBatch.from_pydict({
                        "slot": pa.array(range(len(numbers)), pa.int32()), "place": pa.array([place] * len(numbers), pa.binary()),
                        "sums": pa.array([np.ascontiguousarray(part.sums[:, s].T).tobytes() for s in range(len(numbers))], pa.binary()),
                    })

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for slot, place, sums in zip(*(b.column(i).to_pylist() for i in range(3))):
                    all_sums = held.setdefault(slot, np.zeros((3, cells)))
                    at = np.frombuffer(place, np.int64)
                    for total, v in zip(all_sums, np.frombuffer(sums).reshape(3, -1)):
                        total += np.bincount(at, v, cells)
            for slot, (g, h, n) in held.items():
                i, number, columns = numbers[slot]
                tree = Open(i, number, columns)
                at = tree.grow(plans[i], shape.value, widths, g, h, n, unit)
                value = tree.values(plans[i], unit, bases[i])[at]
                kept = [tree.closed(plans[i], edges, unit, bases[i])] if keep else []
                yield pa.RecordBatch.from_pydict({
                    "number": pa.array([slot], pa.int32()), "part": pa.array([value.tobytes()], pa.binary()), "trees": pa.array([cloudpickle.dumps(kept)], pa.binary()),
                })

        sums = cell_sums(table, plans, bases, self.since, trees).mapInArrow(turned, "slot int, place binary, sums binary")
        tasks = min(len(trees), table.rows.sparkSession.sparkContext.defaultParallelism)
        for r in sorted(sums.repartition(tasks, "slot").mapInArrow(read, GROWN).collect(), key=lambda r: r["number"]):
            i = numbers[r["number"]][0]
            value = np.frombuffer(r["part"])
            self.found[i] += value / plans[i].trees if plans[i].style == "forest" else value
            self.done[i] += cloudpickle.loads(r["trees"])

    def _bases(self) -> list[float]:
        """The mean label of the rows that each plan sees."""
        y = F.floor(F.col("__y") / F.lit(self.table.unit) + 0.5).cast("decimal(38,0)")
        seen: dict[tuple, int] = {}
        columns = []
        for p in self.plans:
            if p.held not in seen:
                mask = F.lit(True)
                for c, f in p.held:
                    mask = mask & (F.col(f"__f{self.table.folds.index(c)}") != f)
                seen[p.held] = len(seen)
                columns += [F.sum(F.when(mask, y)), F.count(F.when(mask, F.lit(1)))]
        row = self.table.rows.agg(*[c.alias(f"a{i}") for i, c in enumerate(columns)]).first()
        means = [float(int(row[2 * i] or 0)) / max(row[2 * i + 1], 1) * self.table.unit for i in range(len(seen))]
        return [means[seen[p.held]] for p in self.plans]

    def grow(self, keep: bool = True) -> list[Ensemble]:
        """``keep``: whether the trees are wanted; predictions need them only where there are few levels to grow."""
        known = self._known()
        if known and self.table.count <= HELD_ROWS:
            self._alone(keep)
            return self._ensembles()
        forests = [Open(i, t, columns_of(p, t, len(self.table.edges))) for i, p in enumerate(self.plans) if p.style == "forest" for t in range(p.trees)]
        if known:  # forests with the same seed share a tree's draw
            forests.sort(key=lambda t: t.tree)
        for start in range(0, len(forests), 64):  # bounds what one pass sums up
            if known:
                self._whole_trees(forests[start : start + 64], keep)
            else:
                self.close(self.levels(forests[start : start + 64]))
        boosted = [i for i, p in enumerate(self.plans) if p.style != "forest"]
        for number in range(max((self.plans[i].trees for i in boosted), default=0)):
            now = [Open(i, number, columns_of(self.plans[i], number, len(self.table.edges))) for i in boosted if number < self.plans[i].trees]
            if known:
                self._whole_trees(now, keep)
                continue
            self.close(self.levels(now))
            if (number + 1) % WRITE_EVERY == 0:
                self.write()
        return self._ensembles()

    def _ensembles(self) -> list[Ensemble]:
        return [
            Ensemble(trees, base if plan.style != "forest" else 0.0, "mean" if plan.style == "forest" else "sum")
            for trees, base, plan in zip(self.done, self.bases, self.plans)
        ]

    def levels(self, trees: list[Open]) -> list[Open]:
        cells = materialize(cell_sums(self.table, self.plans, self.bases, self.since, trees), "cells") if self.table.crowded else None
        while places := [i for i, t in enumerate(trees) if t.frontier]:
            going = [trees[i] for i in places]
            by_slot = [self.plans[t.plan] for t in going]
            sums = histograms(self.table, self.plans, self.bases, self.since, going, cells, places)
            found: dict[int, dict[int, tuple]] = {}
            for r in best_splits(sums, by_slot, self.table.unit).collect():  # one row per open node
                found.setdefault(r["slot"], {})[r["node"]] = tuple(r)[2:]
            for slot, t in enumerate(going):
                t.split(by_slot[slot], found.get(slot, {}))
        return trees

    def close(self, trees: list[Open]) -> None:
        for t in trees:
            plan = self.plans[t.plan]
            tree = t.closed(plan, self.table.edges, self.table.unit, self.bases[t.plan])
            self.done[t.plan].append(tree)
            if plan.style != "forest":
                self.since[t.plan].append(tree)

    def predicted(self, only_held: bool = False, forests: bool = True) -> DataFrame:
        """The table's rows with ``__p``: every plan's prediction (``only_held``: a forest's is 0 for rows that it has seen)."""
        plans, bases, folds, unit = self.plans, self.bases, self.table.folds, self.table.unit
        trees = [(d if forests else []) if p.style == "forest" else s for p, d, s in zip(plans, self.done, self.since)]
        names = [c for c in self.table.rows.columns if c != "__p"]
        if self.keys is not None:
            self._tell()
        known, strides = self.table.known, strides_of(self.table.edges)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches):
                part = Part(block, folds, unit, known.value if known else None, strides)
                out = np.zeros((len(part.y), len(plans)))
                for i, p in enumerate(plans):
                    if known:
                        out[:, i] = part.known[i][part.run]
                        if p.style == "forest" and only_held:
                            out[part.sees(p), i] = 0.0
                    elif p.style == "forest":
                        rows = np.flatnonzero(~part.sees(p)) if only_held else np.arange(len(part.y))
                        asked = np.unique(part.run[rows])
                        value = np.zeros(len(part.starts))
                        for t in trees[i]:
                            value[asked] += t.value[t.places(part.distinct[asked])] / len(trees[i])
                        out[rows, i] = value[part.run[rows]]
                    else:
                        out[:, i] = part.predicted(i, bases[i], trees[i])
                a = 0
                for batch in block:
                    own = out[a : a + batch.num_rows]
                    a += batch.num_rows
                    lists = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * len(plans), pa.array(own.ravel()))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], [*names, "__p"])

        schema = self.table.rows.select(*names).withColumn("__p", F.array(F.lit(0.0))).schema
        return self.table.rows.mapInArrow(read, schema)

    def write(self) -> None:
        """Cuts off what a pass has to do over: predictions so far are written with the rows."""
        self.table.rows = materialize(self.predicted(forests=False), "boosted")
        self.since = [[] for _ in self.plans]
