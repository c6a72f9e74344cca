"""Clusters of integer vectors by Lloyd's rounds whose dimensions are sharded.

Vectors are laid out in tiles of rows, each cut into blocks of columns; a task works on one block of columns and needs
only that slice of the centroids. Partial distances of a tile's blocks are added with reduceByKey and the smallest sum
names the cluster. Only the labels (one number a vector) go back to the blocks, which stay where they are, and each
block sums its own columns and makes its own slice of the next centroids. All arithmetic is on integers, so the
result does not depend on how the rows are dealt out.

Rows whose vector is null, has another length, or holds a null or non-finite component take no part. Rows with a null id
take part; as a seed their id counts as the empty text. Repeated ids and repeated rows are clustered each for
itself; equal seed hashes are ordered by the vector. With fewer vectors than centroids there are as many
centroids as vectors; an empty table gives no rows. A component beyond +-2**26 after scaling is an error: the
squared distance would not fit a long. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.shared import col, local_frame, materialize

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64.0
COLUMNS = 16  # of a block
TILE = 4096  # vectors
LARGEST = 1 << 26
TILES = "tile long, block int, ids binary, data binary"


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(vec, x): the vectors that take part."""
    read = vectors.select(col(id_col).cast("long").alias("vec"), col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return read.where((F.size("x") == dims) & finite)


def whole_numbers(x: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(x * scale).astype(np.int64)


def seeds(kept: DataFrame, k: int, scale: float) -> np.ndarray:
    """The first centroids: the ``k`` vectors whose ids have the smallest hashes."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(name, "x").limit(k).collect()
    return whole_numbers(np.array([r["x"] for r in first]), scale) if first else np.zeros((0, 0), np.int64)


def tiled(kept: DataFrame, dims: int, scale: float, columns: int) -> DataFrame:
    """One row per (tile, block of columns); a tile's ids go with its first block."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for a in range(0, batch.num_rows, TILE):
                part = batch.slice(a, TILE)
                x = whole_numbers(part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale).astype(np.int32)
                ids = part.column("vec")
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, pa.schema([("vec", pa.int64())])) as out:
                    out.write_batch(pa.record_batch([ids], names=["vec"]))
                cuts = range(0, dims, columns)
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([base + n] * len(cuts), pa.int64()), "block": pa.array(range(len(cuts)), pa.int32()),
                    "ids": pa.array([sink.getvalue().to_pybytes()] + [None] * (len(cuts) - 1), pa.binary()),
                    "data": pa.array([np.ascontiguousarray(x[:, c : c + columns]).tobytes() for c in cuts], pa.binary()),
                })
                n += 1

    return kept.mapInArrow(read, TILES)


def partial_distances(x: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """(vectors, centroids): exact squared distances over the columns of one block."""
    out = np.empty((len(x), len(slice_)), np.int64)
    for j, c in enumerate(slice_):
        gap = x - c
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def own_sums(x: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a block's columns and counts of vectors by cluster."""
    order = np.argsort(labels, kind="stable")
    there, starts = np.unique(labels[order], return_index=True)
    sums, counts = np.zeros((k, x.shape[1]), np.int64), np.zeros(k, np.int64)
    sums[there] = np.add.reduceat(x[order], starts, axis=0)
    counts[there] = np.diff(np.append(starts, len(labels)))
    return sums, counts


class Shards:
    """The blocks, dealt out so that a task holds blocks of the same columns only."""

    def __init__(self, tiles: DataFrame, blocks: int, columns: int):
        self.blocks = blocks
        per_block = max(1, -(-tiles.rdd.getNumPartitions() // blocks))
        self.tasks = per_block * blocks

        def place(key: tuple[int, int]) -> int:
            tile, block = key
            return block * per_block + ((tile >> 32) * 31 + (tile & 0xFFFFFFFF)) % per_block

        def widths(row) -> tuple:
            x = np.frombuffer(row["data"], np.int32).astype(np.int64)
            return (row["tile"], row["block"]), (row["ids"], x.reshape(-1, width_of[row["block"]]))

        width_of = columns_of(blocks, columns)
        self.place = place
        self.data: RDD = tiles.rdd.map(widths).partitionBy(self.tasks, place).persist(StorageLevel.DISK_ONLY)

    def distances(self, slices: list[np.ndarray], with_ids: bool = False) -> RDD:
        """tile -> (ids, distances to every centroid), added over the blocks."""

        def measured(item):
            (tile, block), (ids, x) = item
            return tile, (ids if with_ids else None, partial_distances(x, slices[block]))

        return self.data.map(measured).reduceByKey(lambda a, b: (a[0] or b[0], a[1] + b[1]), self.tasks, lambda tile: (tile >> 32) * 31 + (tile & 0xFFFFFFFF))

    def updated(self, slices: list[np.ndarray], whole: RDD) -> list[np.ndarray]:
        """The next centroids: each block makes its own slice. Labels move, blocks do not."""
        blocks, k = self.blocks, len(slices[0])

        def labelled(item):
            tile, (_, d) = item
            labels = d.argmin(axis=1).astype(np.int32)  # the first of equals
            return [((tile, b), labels) for b in range(blocks)]

        def summed(item):
            (_, block), parts = item
            labels, x = None, None
            for p in parts:
                if isinstance(p, tuple):
                    x = p[1]
                else:
                    labels = p
            return block, own_sums(x, labels, k)

        def moved(item):
            block, (sums, counts) = item
            full = counts > 0
            out = slices[block].copy()
            out[full] = sums[full] // counts[full, None]
            return block, out

        labels = whole.flatMap(labelled).partitionBy(self.tasks, self.place)
        both = labels.union(self.data).groupByKey(self.tasks, self.place)  # dealt out alike already: nothing moves
        sums = both.map(summed).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), blocks, int)
        found = dict(sums.map(moved).collect())  # centroids x columns of a block each
        return [found[b] for b in range(blocks)]


def columns_of(blocks: int, columns: int, dims: int = DIMS) -> list[int]:
    return [min(columns, dims - b * columns) for b in range(blocks)]


def clustered(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that takes part."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_col, vector_col, DIMS)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    largest = kept.select(F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("m")).first()["m"]
    if largest is None:
        return local_frame(spark, [], schema)
    if largest * SCALE >= LARGEST:
        raise ValueError(f"a component of {largest} is too large: squared distances would not fit a long")
    centroids = seeds(kept, k, SCALE)
    blocks = -(-DIMS // COLUMNS)
    slices = [np.ascontiguousarray(centroids[:, b * COLUMNS : (b + 1) * COLUMNS]) for b in range(blocks)]
    shards = Shards(materialize(tiled(kept, DIMS, SCALE, COLUMNS), "tiles"), blocks, COLUMNS)
    for _ in range(rounds):
        slices = shards.updated(slices, shards.distances(slices))

    def packed(item):
        _, (ids, d) = item
        labels = d.argmin(axis=1)
        return ids, labels.astype(np.int32).tobytes(), d[np.arange(len(d)), labels].tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, distances in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with pa.ipc.open_stream(ids) as names:
                    vec = names.read_all().column("vec").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [vec, pa.array(np.frombuffer(labels, np.int32)), pa.array(np.frombuffer(distances, np.int64))], ["vec_id", "cluster", "distance"]
                )

    tiles = spark.createDataFrame(shards.distances(slices, with_ids=True).map(packed), "ids binary, labels binary, distances binary")
    found = materialize(tiles, "labels").mapInArrow(rows, "vec_id long, cluster int, distance long")
    shards.data.unpersist()
    final = np.concatenate(slices, axis=1)
    names = [(j, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(final)]
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = [(r["cluster"], r["cluster_inertia"]) for r in by_cluster.collect()]  # at most k rows
    total, named = sum(s for _, s in sums), dict(names)
    stats = local_frame(spark, [(c, s, total, named[c]) for c, s in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(stats), "cluster")  # at most k rows
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clusters_sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same rows in SQL; vec_id must be unique."""
    hash_order = "sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v"

    def assigned(i: int) -> str:
        return f"""a{i} AS (SELECT vec_id, v, cluster, c, distance FROM (
  SELECT vec_id, v, cluster, c, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance FROM kept, c{i})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""

    def moved(i: int) -> str:
        return f"""s{i} AS (SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i}) GROUP BY cluster, d),
n{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT c{i}.cluster, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} USING (cluster))"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(rounds))
    return f"""WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY {hash_order}) - 1 AS INTEGER) AS cluster, v AS c FROM kept
       QUALIFY row_number() OVER (ORDER BY {hash_order}) <= {k}),
{steps},
{assigned(rounds)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds}"""
