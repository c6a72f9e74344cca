"""Approximate nearest neighbours by a forest of random-projection trees; nearness is the inner product.

Vectors get one more coordinate, which gives all the same length; then the largest inner product is the
smallest angle (a query's extra coordinate is 0). Trees are fitted on at most ``SAMPLE`` vectors, taken in the
order of a hash: a node splits at the median along the line through two of its vectors. Every row is indexed.
A query walks all trees through one priority queue, leaves with the largest sum of margins on their path first, and takes leaves until they
hold a number of rows that is measured: for ``PROBED`` queries the true neighbours are found by brute force, and the number
is the least that finds ``TARGET`` of them. So vectors with clusters take few leaves and vectors without any
take more, at any size of the table. Candidates are compared exactly, in double precision on the original vectors.

Rows and queries meet by bundles of neighbouring leaves, in tiles of at most ``TILE`` rows and queries each. A task streams
its tiles and keeps the ``k + 1`` best of each query over all of them.

Equal vectors are one node of the index; of each, the ``k + 1`` smallest ids are kept, which is all that
``k`` nearest rows (ties to the smaller id, the own row left out) can contain.

Defined results: vectors that are null, zero, hold null or non-finite numbers, or whose length is not the
most frequent one take no part, nor do rows without id. Of rows with equal id and vector one counts.
A table with fewer than ``k`` candidates gives all of them. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.batches import mixed, shipped, tidy
from gablework.llm.owners import arrow_schema
from gablework.shared import col, lookup_join, materialize

TREES = 16
LEAF = 32
BUNDLE = 64  # leaves
SAMPLE = 60_000
SEARCHED = 1500  # rows at least, over all trees
TARGET = 0.93
PROBED = 100
TILE = 4096
HELD = 2_000_000  # candidates that a task holds
SALTS = 64
SEED = 7
VECTORS = T.StructType([T.StructField("rep", T.LongType()), T.StructField("vector", T.BinaryType())])
MET = T.StructType([
    T.StructField("tile", T.LongType()), T.StructField("asks", T.IntegerType()), *VECTORS.fields, T.StructField("leaves", T.ArrayType(T.IntegerType())),
])
SCORES = T.StructType([T.StructField("query", T.LongType()), T.StructField("rep", T.LongType()), T.StructField("score", T.DoubleType())])


@dataclass
class Forest:
    """Nodes of all trees in one array; a negative child -1 - n is leaf n."""

    roots: list[int]
    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray  # nodes x 2
    leaves: int
    length: float  # the common length of the extended vectors
    levels: list[np.ndarray]  # nodes by depth

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.length**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree: trees x vectors."""
        y, out = self.extended(x), []
        for root in self.roots:
            node = np.full(len(x), root)
            while len(inner := np.flatnonzero(node >= 0)):
                at = node[inner]
                side = np.einsum("nd,nd->n", y[inner], self.normals[at]) > self.offsets[at]
                node[inner] = self.children[at, side.astype(int)]
            out.append(-1 - node)
        return np.array(out)

    def best_below(self, margins: np.ndarray) -> np.ndarray:
        """The largest sum of margins on any way down from every node, for all queries at once."""
        below = np.zeros((len(margins), len(self.normals) + 1))  # the last: a leaf has nothing below
        for nodes in self.levels[::-1]:
            left, right = (np.where(c >= 0, c, len(self.normals)) for c in self.children[nodes].T)
            below[:, nodes] = np.maximum(below[:, left] - margins[:, nodes], below[:, right] + margins[:, nodes])
        return below

    def search(self, m: list[float], b: list[float], children: list[list[int]], sizes: list[int], wanted: float) -> list[int]:
        """Leaves of one query, the largest sums of margins first, until they hold ``wanted`` rows.

        All trees share the queue; a node stands in it with the best sum that a leaf under it can have."""
        queue = [(-b[max(root, -1)], root, 0.0) for root in self.roots]
        heapq.heapify(queue)
        found, rows = [], 0
        while queue and rows < wanted:
            _, node, so_far = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                rows += sizes[-1 - node]
                continue
            left, right = children[node]
            for child, total in ((left, so_far - m[node]), (right, so_far + m[node])):
                heapq.heappush(queue, (-total - b[max(child, -1)], child, total))
        return found

    def searched(self, x: np.ndarray, sizes: np.ndarray, wanted: float) -> list[list[int]]:
        margins = self.margins(x)
        children, counts = self.children.tolist(), sizes.tolist()
        return [self.search(m.tolist(), b.tolist(), children, counts, wanted) for m, b in zip(margins, self.best_below(margins))]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Of queries at every node, stretched to the common length."""
        if not len(self.normals):
            return np.zeros((len(x), 0))
        y = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        y *= self.length / np.sqrt((x * x).sum(axis=1))[:, None]
        return y @ self.normals.T - self.offsets


def fit(sample: np.ndarray, length: float, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> Forest:
    forest = Forest([], np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2)), 0, length, [])
    y, rng = forest.extended(sample), np.random.default_rng(seed)
    normals, offsets, children, depths = [], [], [], []
    for _ in range(trees):
        forest.roots.append(len(normals) if len(y) > leaf else -1 - forest.leaves)
        todo = [(np.arange(len(y)), None, 0, 0)]
        while todo:
            rows, parent, side, depth = todo.pop()
            if len(rows) <= leaf:
                name = -1 - forest.leaves
                forest.leaves += 1
            else:
                a, b = y[rng.choice(rows, 2, replace=False)]
                normal = (a - b) / max(np.linalg.norm(a - b), 1e-12)
                along = y[rows] @ normal
                offset = float(np.median(along))
                right = along > offset
                if right.all() or not right.any():  # hardly ever: equal places along the line
                    right = np.zeros(len(rows), bool)
                    right[rng.permutation(len(rows))[: len(rows) // 2]] = True
                name = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                depths.append(depth)
                todo += [(rows[~right], name, 0, depth + 1), (rows[right], name, 1, depth + 1)]
            if parent is not None:
                children[parent][side] = name
    width = y.shape[1]
    forest.normals = np.array(normals).reshape(-1, width)
    forest.offsets, forest.children = np.array(offsets), np.array(children, dtype=np.int64).reshape(-1, 2)
    forest.levels = [np.flatnonzero(np.array(depths) == d) for d in range(max(depths, default=-1) + 1)]
    return forest


def matrix(raw: pa.Array) -> np.ndarray:
    rows = raw.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): doubles as bytes, of the rows that take part."""
    plain = table.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND size(v) > 0")
    usual = plain.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = usual[0]["n"] if usual else 1
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) + 0.0  # -0.0 is 0.0; null is nan
            good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").filter(pa.array(good)), pa.array([r.tobytes() for r in v[good]], pa.binary())], schema=arrow_schema(schema))

    return plain.where(F.size("v") == width).mapInArrow(read, schema).distinct()


def smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """(vector, ids): the ``n`` smallest ids of every vector. A vector of very many rows is first reduced in parts."""
    def first(df: DataFrame, *by) -> DataFrame:
        return df.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("nth") <= n).drop("nth")

    parts = first(rows.withColumn("salt", F.pmod("id", F.lit(SALTS))), "vector", "salt").drop("salt")
    return first(parts, "vector").groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def true_neighbours(vectors: DataFrame, queries: DataFrame, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(query, its ``k`` nearest other vectors) for ``n`` queries in the order of a hash, by brute force over all rows."""
    picked = queries.orderBy(F.xxhash64("rep"), "rep").limit(n).select("rep", "vector").toArrow()
    if not picked.num_rows:
        return []
    q, own = matrix(picked.column("vector").combine_chunks()), picked.column("rep").to_numpy()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, s = batch.column("rep").to_numpy(zero_copy_only=False), q @ matrix(batch.column("vector")).T if batch.num_rows else np.zeros((len(q), 0))
            s[own[:, None] == rep] = -np.inf
            near = np.argsort(-s, axis=1, kind="stable")[:, :k]
            at = near.ravel()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(q)), near.shape[1])), pa.array(rep[at]), pa.array(np.take_along_axis(s, near, 1).ravel()),
                batch.column("vector").take(pa.array(at))], ["query", "rep", "score", "vector"])

    best = _top(vectors.mapInArrow(read, "query long, rep long, score double, vector binary"), "query", k, "rep").where("score > -1e308").toArrow()
    who, x = best.column("query").to_numpy(), matrix(best.column("vector").combine_chunks()) if best.num_rows else np.zeros((0, q.shape[1]))
    return [(q[i], x[who == i]) for i in range(len(q)) if (who == i).any()]


def measured_reach(forest: Forest, known: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray, target: float) -> int:
    """How many rows a query must take so that ``target`` of the known neighbours are among them."""
    reached = []
    for q, x in known:
        order = forest.searched(q[None], sizes, np.inf)[0]
        upto = np.full(len(sizes), np.iinfo(np.int64).max)
        upto[order] = np.cumsum(sizes[order])
        reached += upto[forest.leaves_of(x)].min(axis=0).tolist()
    return int(np.quantile(reached, target, method="higher")) if reached else 0


class Best:
    """The best candidates of each query that a task has seen."""

    def __init__(self, k: int):
        self.k, self.parts, self.size, self.least = k, [], 0, {}

    def add(self, query: np.ndarray, rep: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: queries x rows. What cannot be among a query's best is left out at once."""
        least = np.array([self.least.get(q, -np.inf) for q in query.tolist()])
        if scores.shape[1] > self.k:
            at = scores.shape[1] - self.k
            least = np.maximum(least, np.partition(scores, at, axis=1)[:, at])
        who, which = np.nonzero(scores >= least[:, None])
        self.parts.append((query[who], rep[which], scores[who, which]))
        self.size += len(who)

    def compact(self) -> pa.RecordBatch:
        query, rep, score = (np.concatenate(c) for c in zip(*self.parts)) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((rep, -score, query))
        query, rep, score = query[order], rep[order], score[order]
        if len(query):
            keep = np.append(True, (query[1:] != query[:-1]) | (rep[1:] != rep[:-1]))  # a row has one score, so its copies are neighbours
            query, rep, score = query[keep], rep[keep], score[keep]
            nth = np.arange(len(query)) - np.searchsorted(query, query)
            full = nth == self.k - 1
            self.least.update(zip(query[full].tolist(), score[full].tolist()))
            query, rep, score = query[nth < self.k], rep[nth < self.k], score[nth < self.k]
        self.parts, self.size = [(query, rep, score)], len(query)
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(rep), pa.array(score)], schema=arrow_schema(SCORES))

    def handed_on(self) -> pa.RecordBatch:
        out = self.compact()
        self.parts, self.size, self.least = [], 0, {}
        return out


def dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sums in the order of the components, whatever stands beside them."""
    s = np.zeros((len(q), len(x)))
    for d in range(x.shape[1]):
        s += q[:, d][:, None] * x[:, d]
    return s


def nearest(table: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, searched: int = SEARCHED,
            target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row whose id is divisible by ``every``."""
    rows = materialize(usable(table, id_col, vector_col), "vectors")
    groups = materialize(smallest_ids(rows, k + 1).withColumn("rep", F.col("ids")[0]), "groups")
    vectors = groups.select("rep", "vector")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(axis=1).max())])], names=["longest"])

    longest = vectors.mapInArrow(lengths, "longest double").agg(F.max("longest")).first()[0]
    taken = vectors.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vector").toArrow()
    forest = fit(matrix(taken.column("vector").combine_chunks()) if taken.num_rows else np.zeros((0, 1)),
                 float(np.sqrt(longest or 0.0)), trees, leaf)
    shared = shipped(table.sparkSession, forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(shared().leaves_of(matrix(batch.column("vector"))).ravel().astype(np.int32))], names=["leaf"])

    counted = vectors.mapInArrow(place, "leaf int").groupBy("leaf").count().collect()  # as many rows as the forest has leaves
    sizes = np.zeros(forest.leaves + 1, np.int64)
    for r in counted:
        sizes[r["leaf"]] = r["count"]
    queries = lookup_join(rows.where(F.pmod("id", F.lit(every)) == 0), groups.select("vector", "rep"), ["vector"], kept=True)
    queries = materialize(queries.select("id", "rep", "vector"), "queries")
    asked = queries.select("rep", "vector").distinct()
    wanted = max(searched, (k + 1) * trees, measured_reach(forest, true_neighbours(vectors, asked, PROBED, k), sizes, target))
    # leaves of a tree have neighbouring numbers, and so have the leaves of a bundle
    bundle = np.arange(forest.leaves + 1) // BUNDLE
    held = np.bincount(bundle, sizes).astype(np.int64)
    n_queries = queries.count()
    rounds = max(1, -(-n_queries // TILE))
    asked = asked.repartition(max(1, min(4 * table.sparkSession.sparkContext.defaultParallelism, n_queries // 64)), "rep")  # a walk costs far more than a read
    down = np.maximum(1, -(-held // TILE))  # blocks of rows of a bundle; queries come in blocks by their hash
    first = np.append(0, np.cumsum(down * rounds))

    def met(batch: pa.RecordBatch, at: np.ndarray, leaves: list, to: np.ndarray, asks: int) -> pa.RecordBatch:
        """Rows ``at`` of a batch at the tiles of bundles ``to``: a row goes to all blocks of queries and the reverse."""
        own = mixed(batch.column("rep").to_numpy(zero_copy_only=False).view(np.uint64))[at]
        times = down[to] if asks else np.full(len(to), rounds)
        again = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
        mine = (own % (np.uint64(rounds) if asks else down[to].astype(np.uint64))).astype(np.int64)[again]
        i, j = (nth, mine) if asks else (mine, nth)
        pick = pa.array(at[again])
        lists = pa.array(leaves, pa.list_(pa.int32())).take(pa.array(again))
        return pa.RecordBatch.from_arrays([
            pa.array(first[to[again]] + i * rounds + j), pa.array(np.full(len(again), asks, np.int32)), batch.column("rep").take(pick),
            batch.column("vector").take(pick), lists], schema=arrow_schema(MET))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared()
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                at, to, leaves = [], [], []
                for i, found in enumerate(forest.searched(matrix(part.column("vector")), sizes, wanted)):
                    found = np.sort(np.array(found, np.int64))
                    found = found[sizes[found] > 0]
                    of, starts = np.unique(bundle[found], return_index=True)
                    at += [i] * len(of)
                    to += of.tolist()
                    leaves += [f.tolist() for f in np.split(found, starts[1:])] if len(of) else []
                yield met(part, np.array(at, np.int64), leaves, np.array(to, np.int64), 1)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared()
        for batch in batches:
            if batch.num_rows:
                for of in forest.leaves_of(matrix(batch.column("vector"))):
                    yield met(batch, np.arange(len(of)), of[:, None].tolist(), bundle[of], 0)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rest = Best(k + 1), []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([*rest, batch])
            tile = t.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist()]
            for a, b in zip(cuts[:-1], cuts[1:]):
                compared(t.slice(a, b - a), best)
            rest = t.slice(cuts[-1]).to_batches()  # the last tile may go on
            if best.size > HELD:
                best.compact()
                if best.size > HELD // 2:
                    yield best.handed_on()
        if rest:
            compared(pa.Table.from_batches(rest), best)
        yield best.handed_on()

    meetings = vectors.mapInArrow(offer, MET).union(asked.mapInArrow(ask, MET))
    scored = meetings.repartition("tile").sortWithinPartitions("tile").mapInArrow(tidy(compare), SCORES)
    best = _top(scored.distinct(), "query", k + 1, "rep")
    rows_found = best.join(groups.select("rep", F.explode("ids").alias("vec_id")), "rep").select("query", "score", "vec_id")
    found = materialize(_top(rows_found, "query", k + 1, "vec_id").drop("rank"), "found")
    answers = found.join(queries.select(F.col("id").alias("query_id"), F.col("rep").alias("query")), "query").where("query_id != vec_id")
    return _top(answers, "query_id", k, "vec_id").select("query_id", "rank", "vec_id", "score")


def compared(tile: pa.Table, best: Best) -> None:
    """Queries and rows of one tile that share a leaf."""
    asks, rep = tile.column("asks").to_numpy() == 1, tile.column("rep").to_numpy()
    if asks.all() or not asks.any():
        return
    x, lists = matrix(tile.column("vector").combine_chunks()), tile.column("leaves").combine_chunks()
    leaf, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(rep)), np.diff(lists.offsets.to_numpy()))
    order = np.lexsort((~asks[row], leaf))
    leaf, row = leaf[order], row[order]
    for part in np.split(row, np.flatnonzero(np.diff(leaf)) + 1):
        q, members = part[asks[part]], part[~asks[part]]
        if len(q) and len(members):
            best.add(rep[q], rep[members], dot(x[q], x[members]))


def _top(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
