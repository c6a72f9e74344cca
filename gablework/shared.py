"""Things several operators need: the shared scratch folder, materialised
intermediates, and look-up joins that broadcast only what was measured."""

from __future__ import annotations

import functools
import operator
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A look-up side is broadcast only when it was counted and lies within both.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="gablework-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step", by: str | None = None) -> DataFrame:
    """Write once, read back: cuts the lineage, survives lost executors, and
    gives the optimizer the true size of what follows. ``by`` lays the files out
    by a column of few values, so that a filter on it reads only its own files."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def is_small(kept: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Counts the rows and bytes of a written table; nothing but two numbers reaches the driver."""

    def width(f: T.StructField):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(col(f.name)), F.lit(0)) + 16
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            return F.greatest(F.size(col(f.name)), F.lit(0)) * 64 + 16
        return F.lit(8)

    per_row = functools.reduce(operator.add, [width(f).cast("long") for f in kept.schema])
    rows, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(per_row), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(df: DataFrame, stats: DataFrame, on: Sequence[str], how: str = "left", kept: bool = False) -> DataFrame:
    """Join ``stats`` (one row per key) to ``df``; null keys match null keys.

    The look-up is written once and measured. Within the row and byte bounds it
    is broadcast, so that ``df`` is not shuffled and a hot key costs nothing. A
    larger one is joined by shuffle, where adaptive execution splits hot keys.
    ``kept=True`` says that ``stats`` is a written table already.
    """
    side = stats if kept else materialize(stats, "lookup")
    return safe_join(df, F.broadcast(side) if is_small(side) else side, on, how)


def safe_join(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns where null keys match null keys."""
    renamed = side.select(
        *[F.col(quoted(c)).alias(f"__k_{i}") for i, c in enumerate(on)],
        *[quoted(c) for c in side.columns if c not in on],
    )
    match = functools.reduce(
        operator.and_, [df[quoted(c)].eqNullSafe(renamed[f"__k_{i}"]) for i, c in enumerate(on)]
    )
    return df.join(renamed, match, how).drop(*[f"__k_{i}" for i in range(len(on))])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    """A column by its exact name, dots and leading digits included."""
    return F.col(quoted(name))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]
