"""Arrow batches in tasks: texts as bytes, blocks of bounded size, hashes of sliding windows."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.shared import col

BLOCK_BYTES = 8 << 20
SEGMENT = 1 << 22  # a longer sequence is cut into overlapping segments
PLACE_BITS = 24


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """The two columns an operator reads, under the names ``doc`` and ``text``; ``carry``: others, as ``carried``."""
    more = [F.struct(*[col(c) for c in carry]).alias("carried")] if carry else []
    return docs.select(col(id_col).cast("long").alias("doc"), col(text_col).cast("string").alias("text"), *more)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def ids_of(batch: pa.RecordBatch, name: str = "doc") -> np.ndarray:
    """A long column without nulls."""
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def slices(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``limit`` bytes at most; one text is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits (fixed multipliers of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive tokens; tokens are mixed 64-bit values."""
    base = 0x9E3779B97F4A7C15
    power, length = tokens, 1  # hashes of windows of 1, 2, 4, ... tokens
    out, done = None, 0
    while True:
        if width & length:
            if out is None:
                out = power
            else:
                n = max(0, min(len(out), len(power) - done))
                out = out[:n] * np.uint64(pow(base, length, 1 << 64)) + power[done : done + n]
            done += length
        if done == width:
            return mixed(out[: max(0, len(tokens) - width + 1)])
        n = max(0, len(power) - length)
        power = power[:n] * np.uint64(pow(base, length, 1 << 64)) + power[length : length + n]
        length *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    if len(values) < width:
        return values[:0]
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = width - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(length: int, overlap: int) -> list[tuple[int, int]]:
    """Cuts of a long sequence; neighbours share ``overlap`` tokens, so no window is lost."""
    out, a = [], 0
    while True:
        b = min(length, a + SEGMENT)
        out.append((a, b))
        if b == length:
            return out
        a = b - overlap


class Laid:
    """Token sequences laid end to end; windows that cross from one to the next are not ``valid``."""

    def __init__(self, parts: Sequence[tuple[int, int, np.ndarray]], window: int):
        """``parts``: (row, offset of the segment in its sequence, tokens)."""
        sizes = np.array([len(p[2]) for p in parts], dtype=np.int64)
        self.tokens = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint64)
        self.ends = np.cumsum(sizes)
        starts = self.ends - sizes
        self.rows = np.array([p[0] for p in parts], dtype=np.int64)
        self.shift = np.array([p[1] for p in parts], dtype=np.int64) - starts
        n = max(0, len(self.tokens) - window + 1)
        self.part = np.repeat(np.arange(len(parts)), sizes)[:n] if len(parts) else np.zeros(0, np.int64)
        self.valid = np.arange(n) + window <= self.ends[self.part] if n else np.zeros(0, bool)

    def row(self, at: np.ndarray) -> np.ndarray:
        return self.rows[self.part[at]]

    def place(self, at: np.ndarray) -> np.ndarray:
        """Offsets in the own sequence."""
        return at + self.shift[self.part[at]]


def anchors(gram_hashes: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams, where its smallest gram hash stands (the leftmost of equals).

    The choice depends on the window's content alone, so equal windows have equal anchors."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    marked = (gram_hashes & ~low) | np.arange(len(gram_hashes), dtype=np.uint64)
    return (sliding_min(marked, width) & low).astype(np.int64)


class Remembered(dict):
    """Results of ``make`` by key; beyond ``most`` keys, and for long keys, new ones are made but not kept."""

    def __init__(self, make: Callable[[str], bytes], most: int, longest: int):
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key: str) -> bytes:
        out = self.make(key)
        if len(self) < self.most and len(key) <= self.longest:
            self[key] = out
        return out


def per_worker(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker process, for the tasks that run there one after the other."""
    held = sys.modules.setdefault("gablework_task_memory", types.ModuleType("gablework_task_memory"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def shipped(spark: SparkSession, value: object) -> Callable[[], object]:
    """``value`` for the tasks, with the code of its class, as executors need not have this package."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get() -> object:
        if not held:
            held.append(cloudpickle.loads(packed.value))
        return held[0]

    return get


def long_field(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def with_null_ids(joined: DataFrame, plain: DataFrame, read, schema: T.StructType) -> DataFrame:
    """``read`` over the joined rows and over the rows that have no id, which no join finds."""
    extra = [c for c in joined.columns if c not in plain.columns]
    alone = plain.where("doc IS NULL").select("*", *[F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in extra])
    return joined.mapInArrow(read, schema).union(alone.mapInArrow(read, schema))


def packed(plain: DataFrame) -> DataFrame:
    """The rows that have an id, with compressed texts, for exchanges that carry whole texts."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in plain.schema])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False, write_dict_id=False).compress
        for batch in slices(batches):
            texts = [None if t is None else pack(t) for t in text_bytes(batch)]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.binary()))

    return plain.mapInArrow(read, schema).where("doc IS NOT NULL")  # as joins ask, so that they share the exchange


def unpacked(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The reverse in a task, cut so that the texts of a batch hold about ``limit`` bytes at most."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts, a, size = [], 0, 0
        at = batch.schema.get_field_index("text")
        for i, t in enumerate(batch.column(at)):
            texts.append(unpack(t.as_buffer()) if t.is_valid else None)
            size += len(texts[-1] or b"")
            if size >= limit or i + 1 == batch.num_rows:
                part, texts, size = pa.array(texts, pa.binary()), [], 0  # one copy is held while the caller works
                yield batch.slice(a, i + 1 - a).set_column(at, "text", part)
                a = i + 1
                del part


def tidy(read):
    """``read``, giving freed memory back when a task ends: a Python worker lives on for the tasks of other steps."""

    @functools.wraps(read)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from read(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return whole


def tag_of(text: bytes) -> int:
    """Tells apart the texts of rows with equal ids."""
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def covered(starts: np.ndarray, widths: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + widths, size), -1)
    return np.cumsum(edges[:-1]) > 0
