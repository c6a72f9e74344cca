"""Substring dedup over words, by level-wise doubling.

A word is removed when a window of ``length`` consecutive words that covers it also starts in a
document with a smaller id. Windows of ``length`` are not all counted. Every such window contains an
anchor (its smallest gram, by hash), and so do its equals elsewhere, at the same place. Levels:
grams of a quarter of the length at the anchors; only those that two documents have are extended to
twice as many words; and so on, until the full length is reached or no candidate is left. The last
level compares full windows and finds those that a smaller document has.

Hashes have 64 bits: among n windows compared, a wrong match has a chance of about n / 2**64 each.

Defined results: a null text has no words. A row with a null id is kept whole and takes no part.
Rows with equal ids are the same document (a window of one is never removed for the other). Texts of
fewer than ``length`` words are kept. Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm import owners
from gablework.llm.batches import Laid, anchors, covered, ids_of, keyed_texts, long_field, mixed, segments, slices, tag_of, text_bytes, window_hashes, with_null_ids

LENGTH = 50
ANCHORS = long_field("key", "doc", "next")
WINDOWS = long_field("key", "doc", "tag", "start")
KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
])


def levels(length: int) -> list[int]:
    """Lengths from about a quarter of ``length``, each at most twice the one before."""
    half = -(-length // 2)
    return [-(-half // 2), half, length]


class WordHashes:
    """Hashes of words, kept for the words of one block of texts."""

    def __init__(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        look = self.known.__getitem__
        places = [np.fromiter(map(look, words := (t or b"").split()), np.int64, len(words)) for t in texts]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.known), np.uint64, len(self.known))
        self.known.clear()
        hashes = mixed(hashes)
        return [hashes[p] for p in places]


def _laid(batch: pa.RecordBatch, length: int) -> tuple[Laid, np.ndarray, list[bytes | None]]:
    texts, doc = text_bytes(batch), ids_of(batch)
    parts = [(i, a, h[a:b]) for i, h in enumerate(WordHashes()(texts)) if len(h) >= length
             for a, b in segments(len(h), length - 1)]
    return Laid(parts, length), doc, texts


def _anchored(laid: Laid, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Valid window starts, the anchor place of each, and the gram hashes of the two lower levels."""
    short, middle = levels(length)[:2]
    low, high = window_hashes(laid.tokens, short), window_hashes(laid.tokens, middle)
    at = np.flatnonzero(laid.valid)
    place = anchors(low, length - middle + 1)[at] if len(at) else at
    return at, place, low, high


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(ANCHORS)
        for batch in slices(batches):
            laid, doc, _ = _laid(batch, length)
            at, place, low, high = _anchored(laid, length)
            if not len(at):
                continue
            first = owners.runs(laid.row(at), place)
            owner, p = doc[laid.row(at[first])], place[first]
            key, nxt = owners.live_key(low[p]), high[p].view(np.int64)
            once = np.lexsort((nxt, owner, key))
            once = once[owners.runs(key[once], owner[once], nxt[once])]
            owner, key, nxt = owner[once], key[once], nxt[once]
            live, done = owners.settle_repeated(key, owner)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([key[live], owners.done_key(owner[done], done)])),
                pa.array(np.concatenate([owner[live], owner[done]])),
                pa.array(np.concatenate([nxt[live], nxt[done]])),
            ], schema=schema)

    return docs.mapInArrow(read, ANCHORS)


def extended(survivors: DataFrame) -> DataFrame:
    """The candidates of one level as rows of the next one: the key is the hash of twice as many words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(ANCHORS)
        for batch in batches:
            doc, nxt = ids_of(batch), batch.column("next").to_numpy(zero_copy_only=False)
            key = owners.live_key(nxt.view(np.uint64))
            once = np.lexsort((doc, key))
            once = once[owners.runs(key[once], doc[once])]
            key, doc, nxt = key[once], doc[once], nxt[once]
            live, done = owners.settle_repeated(key, doc)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([key[live], owners.done_key(doc[done], done)])),
                pa.array(np.concatenate([doc[live], doc[done]])),
                pa.array(np.concatenate([nxt[live], nxt[done]])),
            ], schema=schema)

    return survivors.mapInArrow(read, ANCHORS)


def full_windows(docs_with_grams: DataFrame, length: int) -> DataFrame:
    """Rows of the last level: windows whose anchor survived all levels below."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(WINDOWS)
        for batch in slices(batches):
            laid, doc, texts = _laid(batch, length)
            at, place, _, high = _anchored(laid, length)
            if not len(at):
                continue
            grams = batch.column("grams").flatten().to_numpy(zero_copy_only=False)
            survived = np.isin(high[place].view(np.int64), grams)
            at = at[survived]
            row = laid.row(at)
            key, owner = owners.live_key(window_hashes(laid.tokens, length)[at]), doc[row]
            tags = np.array([tag_of(t or b"") for t in texts], dtype=np.int64)[row] if len(row) else row
            start = laid.place(at)
            live, done = owners.settle_later(key, owner)
            order = np.concatenate([live, done])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([key[live], owners.done_key(owner[done], done)])),
                pa.array(owner[order]), pa.array(tags[order]), pa.array(start[order]),
            ], schema=schema)

    return docs_with_grams.mapInArrow(read, WINDOWS)


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row; kept words are joined by one space."""
    plain = keyed_texts(docs, id_col, text_col)
    dealt = plain.where("doc IS NOT NULL").repartition("doc")  # used twice below; the plan keeps one exchange
    candidates = owners.repeated(find_anchors(plain.where("doc IS NOT NULL"), length))
    candidates = owners.repeated(extended(candidates))
    grams = candidates.groupBy("doc").agg(F.collect_set("next").alias("grams"))
    windows = owners.later(full_windows(dealt.hint("merge").join(grams, "doc"), length))
    removed = windows.groupBy("doc").agg(F.collect_list(F.struct("tag", "start")).alias("found"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(KEPT)
        for batch in slices(batches):
            found = batch.column("found")
            n_words, n_removed, kept = [], [], []
            for i, text in enumerate(text_bytes(batch)):
                words = (text or b"").split()
                n_words.append(len(words))
                gone = None
                if found[i].is_valid:
                    pairs = found[i].values
                    start = pairs.field("start").to_numpy(zero_copy_only=False)
                    start = start[pairs.field("tag").to_numpy(zero_copy_only=False) == tag_of(text or b"")]
                    gone = covered(start, np.full(len(start), length), len(words))
                n_removed.append(0 if gone is None else int(gone.sum()))
                rest = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
            ], schema=schema)

    return with_null_ids(dealt.hint("merge").join(removed, "doc", "left"), plain, read, KEPT)
