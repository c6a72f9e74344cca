"""Token ids of a text collection as Parquet files, in ascending order of id.

One row per document: its id, the file part it stands in, the number of ids before it in that part, the
number of ids, and the ids as a list. Parts are ranges of ids, so a reader that asks for some documents
skips files, row groups (statistics) and pages (page index). Ids are dictionary encoded (one dictionary
per row group, 16 bits an id); the rising columns are delta encoded. Counts and places can be read without
the ids: where a document starts in the whole collection is the sum over the parts before plus its offset.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.batches import Remembered, keyed_texts, per_worker, slices, text_bytes
from gablework.llm.owners import arrow_schema
from gablework.llm.piece_model import shared_file, shown_bytes
from gablework.shared import lookup_join

KEPT_WORDS = 700_000  # words whose ids a worker remembers
LONG_WORD = 100  # longer words are not remembered
ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 1000
STORED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
])
SUMS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


class WordCodec:
    """Ids of texts by a tokenizer that drops white space, so that each word can be encoded by itself once."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        self.single = self.tokenizer.model.tokenize
        self.normal = self.tokenizer.normalizer.normalize_str
        self.shown = shown_bytes()
        self.odd = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]").search
        self.parts = re.compile(r"[ \t\n\r]+").split
        self.kept = Remembered(self.one, KEPT_WORDS, LONG_WORD)

    def letters(self, word: str) -> bytes | None:
        """Ids of a word of letters alone, straight from the merges; None for others."""
        if not word.isalpha():
            return None
        if word.isascii():
            shown = word.lower()
        else:
            normal = self.normal(word)
            if not normal.isalpha():
                return None
            shown = "".join([self.shown[b] for b in normal.encode()])
        ids = [t.id for t in self.single(shown)]
        return pack(f"<{len(ids)}I", *ids)

    def one(self, word: str) -> bytes:
        if (ids := self.letters(word)) is not None:
            return ids
        if word[-1] in ",.!?;:" and (ids := self.letters(word[:-1])) is not None:
            return ids + self.kept[word[-1]]
        found = self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids
        return pack(f"<{len(found)}I", *found)

    def words(self, text: str) -> list[str]:
        if text.isascii() and "<|" not in text:
            text = text.lower()
        return [w for w in self.parts(text) if w] if self.odd(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.kept.__getitem__, self.words(t))) for t in texts]


def ordered_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Parts are ranges of ids; rows with equal ids stand next to each other, in the order of their texts' hashes."""
    marked = keyed_texts(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    return marked.repartitionByRange("doc", "tag").sortWithinPartitions("doc", "tag")


def write_tokens(docs: DataFrame, path: str, codec: Callable[[], object], end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Encode and write in one pass after the sort. ``codec()`` is called in every task; its ``encode`` gives
    little-endian 32-bit ids. ``end_id`` is appended to every document, an empty or null text has only that."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, schema, part = codec(), arrow_schema(STORED), TaskContext.get().partitionId()
        end, before = np.array([end_id], "<u4").tobytes(), 0
        for batch in slices(batches, 2 << 20):
            ids = [x + end for x in encoder.encode([(t or b"").decode() for t in text_bytes(batch)])]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            offsets = np.append(0, np.cumsum(sizes))
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values).cast(schema.field("ids").type)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(np.full(len(ids), part, np.int32)), pa.array(before + offsets[:-1]), pa.array(sizes), lists,
            ], schema=schema)
            before += int(offsets[-1])

    rows = ordered_texts(docs, id_col, text_col).mapInArrow(read, STORED)
    writer = rows.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    for column in ("doc_id", "before", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")  # delta encoded instead
    (writer.option("parquet.enable.dictionary", "true").option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.row.count.limit", str(page_rows)).parquet(path))


def part_starts(stored: DataFrame) -> DataFrame:
    """(part, first): the number of ids in all parts before; reads two narrow columns."""
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("ids_in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file part
    return sums.select("part", F.coalesce(F.sum("ids_in_part").over(before), F.lit(0)).cast("long").alias("first"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def checked(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for every document, from the files alone."""
    stored = read_tokens(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SUMS)
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"), batch.column("before"), pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(crc, pa.int64()),
            ], schema=schema)

    found = lookup_join(stored.mapInArrow(read, SUMS), part_starts(stored), ["part"])
    return found.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_codec(spark: SparkSession, path: str) -> Callable[[], WordCodec]:
    file = shared_file(spark, path)
    name = f"words_{zlib.crc32(file.value):08x}"
    return lambda: per_worker(name, lambda: WordCodec(file.value))
