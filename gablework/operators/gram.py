"""Cross-product sums of many columns: one small matrix per task, summed by row in two steps."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.shared import col

# The tasks get this code with their work, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 64
FLAT = 1e-13  # a variance below this share of the mean square is none
PARTS = ("xy", "n", "x", "y", "xx", "yy")


def means(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Centres to sum about; 0 for a column without values."""
    row = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([0.0 if m is None or m != m else m for m in row])


def summed(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Arrays added up per key; the partial ones of many tasks meet in ``SALTS`` groups first."""
    salted = parts.withColumn("salt", F.spark_partition_id() % SALTS)
    first = salted.groupBy(*keys, "salt").agg(Summarizer.sum(array_to_vector(F.col("sums"))).alias("sums"))
    return first.groupBy(*keys).agg(vector_to_array(Summarizer.sum(F.col("sums"))).alias("sums"))


def cross_sums(df: DataFrame, columns: Sequence[str], cells: Sequence[str], origin: np.ndarray) -> DataFrame:
    """(cell, row, sums): row ``i`` of [1, x...] times itself about ``origin``, per combination of the cell columns.

    Values must be present. A cell is an array of ints."""
    width = len(columns) + 1
    rows = df.select(*[col(c).cast("int").alias(f"c{i}") for i, c in enumerate(cells)], *[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, ...], np.ndarray] = {}
        for batch in batches:
            data = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.column_stack([np.ones(batch.num_rows), *data[len(cells) :]])
            x[:, 1:] -= origin
            names = np.column_stack(data[: len(cells)]) if cells else np.zeros((batch.num_rows, 0), np.int64)
            for cell in map(tuple, np.unique(names, axis=0).tolist()) if batch.num_rows else ():
                part = x[(names == cell).all(axis=1)]
                sums[cell] = sums.get(cell, 0.0) + part.T @ part
        for cell, total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array([list(cell)] * width, pa.list_(pa.int32())), "row": pa.array(range(width), pa.int32()),
                "sums": pa.array(list(total), pa.list_(pa.float64())),
            })

    return summed(rows.mapInArrow(read, "cell array<int>, row int, sums array<double>"), ["cell", "row"])


def matrices(sums: DataFrame) -> dict[tuple[int, ...], np.ndarray]:
    """{cell: matrix}; as large as columns squared, whatever the number of rows."""
    out: dict[tuple[int, ...], np.ndarray] = {}
    for r in sums.collect():
        size = len(r["sums"])
        out.setdefault(tuple(r["cell"]), np.zeros((size, size)))[r["row"]] = r["sums"]
    return dict(sorted(out.items()))


def masked_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(row, xy, n, x, y, xx, yy): for column ``row`` and each column not before it, the sums over rows in which both are present.

    Values are taken about the column means."""
    origin, width = means(df, columns), len(columns)
    rows = df.select(*[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(PARTS), width, width))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - origin
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            x2 = x * x
            for total, part in zip(sums, (x.T @ x, m.T @ m, x.T @ m, m.T @ x, x2.T @ m, m.T @ x2)):
                total += part
        upper = [sums[:, i, i:].ravel() for i in range(width)]
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(width), pa.int32()), "sums": pa.array(upper, pa.list_(pa.float64()))})

    found = summed(rows.mapInArrow(read, "row int, sums array<double>"), ["row"])
    n = F.lit(width) - F.col("row")
    return found.select("row", *[F.slice("sums", F.lit(i) * n + 1, n).alias(p) for i, p in enumerate(PARTS)])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) of every pair, both orders and the diagonal, over rows with both values; NULL where one of them is constant."""
    sums = masked_sums(df, columns)
    pairs = sums.select("row", F.posexplode(F.arrays_zip(*PARTS)).alias("place", "s"))
    n = F.nullif(F.col("s.n"), F.lit(0.0))
    mean_x, mean_y = F.col("s.x") / n, F.col("s.y") / n

    def spread(square, mean):
        variance = F.col(square) / n - mean * mean
        return F.when(variance > F.lit(FLAT) * F.col(square) / n, variance)

    r = (F.col("s.xy") / n - mean_x * mean_y) / (F.sqrt(spread("s.xx", mean_x)) * F.sqrt(spread("s.yy", mean_y)))
    names = F.array(*[F.lit(c) for c in columns])
    half = pairs.select(F.get(names, F.col("row")).alias("a"), F.get(names, F.col("row") + F.col("place")).alias("b"), r.alias("r"), (F.col("place") == 0).alias("same"))
    both = F.when(F.col("same"), F.array(F.struct("a", "b"))).otherwise(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return half.select("r", F.inline(both)).select("a", "b", "r")
