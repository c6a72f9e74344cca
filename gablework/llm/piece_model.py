"""Byte-level BPE with sentencepiece: its model is written from a rank file, nothing is trained.

Every byte is shown as one printable character (the usual table of byte-level vocabularies), every
token as the characters of its bytes. A piece's score is its negative rank, so that sentencepiece merges
the pair of lowest rank first, the leftmost of equals, as the rank file asks. Normalisation is
identity: no prefix, no escaping, no removal of spaces. The pattern splits a text before; every match
is encoded on its own, and a worker remembers the ids of those it has met.
"""

from __future__ import annotations

import base64
import re
import zlib

from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gablework.llm.batches import Remembered, keyed_texts, per_worker, slices, text_bytes, tidy
from gablework.llm.owners import arrow_schema

KEPT_PIECES, KEPT_WORDS = 50_000, 100_000  # matches and words whose ids a worker remembers
LONG_PIECE = 200  # longer matches are not remembered
MAX_VOCABULARY_BYTES = 64 << 20
LISTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType()),
])
ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType()),
])


def shown_bytes() -> list[str]:
    """A printable character for each byte: printable Latin-1 ones stand for themselves, the others are moved up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(moved)}
    return [table[b] for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, a varint or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + np.float32(value).tobytes()
    return _varint(number << 3) + _varint(value)


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model: piece n is the token of rank n, the unknown piece comes last."""
    shown = shown_bytes()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    out = [_field(1, _field(1, "".join(shown[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, 1))
           for token, rank in by_rank]  # 3: type normal
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))  # type unknown
    size = len(by_rank) + 1
    none = (1 << 64) - 1  # -1: no such piece
    trainer = (_field(3, 2) + _field(4, size) + _field(35, 0) + _field(40, size - 1) + _field(41, none) + _field(42, none)
               + _field(43, none))  # model type BPE, size, no byte fallback, ids of unk, bos, eos, pad
    out.append(_field(2, trainer))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, no trimming, no escaping
    out.append(_field(3, normaliser))
    return b"".join(out)


class PieceCodec:
    """Encodes and decodes texts."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = read_ranks(rank_file)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.ranks))
        self.tokens = [t for t, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.shown = {b: s for b, s in enumerate(shown_bytes())}
        self.split = regex.compile(pattern).findall
        self.parts = re.compile(r"(?<=\S) (?=\S)").split
        self.pieces = Remembered(self.piece, KEPT_PIECES, LONG_PIECE)
        self.words = Remembered(self.word, KEPT_WORDS, LONG_PIECE)

    def piece(self, piece: str) -> bytes:
        """Ids of one match, as little-endian 32-bit integers. A match that is a token is that token."""
        raw = piece.encode()
        if (rank := self.ranks.get(raw)) is not None:
            return rank.to_bytes(4, "little")
        ids = self.model.encode("".join(map(self.shown.__getitem__, raw)))
        return pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        """Ids of a space and what follows up to the next one."""
        if word.isalpha():  # one match of the pattern
            return self.piece(" " + word)
        return b"".join(map(self.pieces.__getitem__, self.split(" " + word)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """No match of the pattern crosses a single space between two characters that are no spaces, except
        that the space may begin one. So the parts between are encoded once each, with the space before."""
        out = []
        for text in texts:
            first, *rest = self.parts(text)
            out.append(b"".join(map(self.pieces.__getitem__, self.split(first))) + b"".join(map(self.words.__getitem__, rest)))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec_of(file: bytes, pattern: str) -> PieceCodec:
    return per_worker(f"pieces_{zlib.crc32(file + pattern.encode()):08x}", lambda: PieceCodec(file, pattern))


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, read by the driver and sent to the tasks; its size is checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def encoded(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row, in one narrow pass.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded`` are the bytes that the ids stand for.
    Defined results: a null or empty text has no tokens. Repeated rows and null ids are rows like any
    other. Other columns are not read. An empty table gives an empty one.
    """
    file = shared_file(docs.sparkSession, rank_path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = codec_of(file.value, pattern), arrow_schema(ENCODED)
        for batch in slices(batches, 2 << 20):
            ids = codec.encode([(t or b"").decode() for t in text_bytes(batch)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary()),
            ], schema=schema)

    return keyed_texts(docs, id_col, text_col).mapInArrow(tidy(read), ENCODED)




def token_lists(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): ids as a list, and whether they decode to the text's bytes."""
    file = shared_file(docs.sparkSession, rank_path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = codec_of(file.value, pattern), arrow_schema(LISTS)
        for batch in slices(batches, 2 << 20):
            raw = [t or b"" for t in text_bytes(batch)]
            ids = codec.encode([t.decode() for t in raw])
            ends = np.append(0, np.cumsum([len(x) // 4 for x in ids])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(np.diff(ends).astype(np.int64)), lists.cast(schema.field("ids").type),
                pa.array([codec.decode(x) == t for x, t in zip(ids, raw, strict=True)])], schema=schema)

    return keyed_texts(docs, id_col, text_col).mapInArrow(tidy(read), LISTS)
