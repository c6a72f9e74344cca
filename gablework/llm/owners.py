"""Which keys occur in more than one document, and which rows have the key of a smaller document.

Rows are (key, doc, ...). They are dealt out by key, sorted by (key, doc) and read as a stream, so a
task keeps one document's rows of one key at most, whatever the size of the group. Before that,
each batch settles what it can by itself: a key's rows in a batch are reduced to one document's, so
that a hot key sends a few rows per batch. What is settled goes on as *done* rows, spread evenly.

``key`` is even for rows that are still compared and odd for done rows, whose place is random.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gablework.llm.batches import mixed, tidy

ONE = np.uint64(1)


def live_key(h: np.ndarray) -> np.ndarray:
    return (h & ~ONE).astype(np.uint64).view(np.int64)


def done_key(doc: np.ndarray, n: np.ndarray) -> np.ndarray:
    spread = mixed(doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64))
    return (spread | ONE).view(np.int64)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def first_of_run(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.repeat(values[starts], np.diff(np.append(starts, len(values))))


def settle_repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers that stay live, and row numbers known to be repeated, of one batch.

    One document's rows of each key stay live; a key that two documents of the batch have is repeated."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    starts = runs(k)
    first = first_of_run(d, starts)
    last = np.repeat(d[np.append(starts[1:], len(k)) - 1], np.diff(np.append(starts, len(k)))) if len(k) else d
    return order[d == first], order[first < last]


def settle_later(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers that stay live (each key's smallest document), and those with a smaller document's key."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    later = d > first_of_run(d, runs(k))
    return order[~later], order[later]


def sorted_by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "doc")


def streamed(rows: DataFrame, read: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    return sorted_by_key(rows).mapInArrow(tidy(read), schema)


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose key two documents have, and the done rows. Same columns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of a key that only one document had so far
        held_key = held_doc = known = None  # known: the last key, when it is known to be repeated
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            if not len(key):
                continue
            live = (key & 1) == 0
            starts = runs(key)
            ends = np.append(starts[1:], len(key))
            twice = doc[ends - 1] > doc[starts]
            if key[0] == known or (held and key[0] == held_key and doc[ends[0] - 1] > held_doc):
                twice[0] = True
                yield from held
                held = []
            elif held and key[0] != held_key:
                held = []
            keep = ~live | np.repeat(twice, ends - starts)
            last = key[-1]
            if twice[-1] and live[-1]:
                known, held = last, []
            else:
                known = None
                if live[-1]:
                    if not (held and held_key == last):
                        held, held_key, held_doc = [], last, doc[starts[-1]]
                    held.append(batch.slice(starts[-1]))
                else:
                    held = []
            if keep.any():
                yield batch.filter(pa.array(keep))

    return streamed(rows, read, rows.schema)


def later(rows: DataFrame) -> DataFrame:
    """The rows whose key a smaller document has too, and the done rows. Same columns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = owner = None
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            if not len(key):
                continue
            starts = runs(key)
            first = doc[starts].copy()
            if key[0] == last_key:
                first[0] = owner
            keep = ((key & 1) == 1) | (doc > np.repeat(first, np.diff(np.append(starts, len(key)))))
            last_key, owner = key[-1], first[-1]
            if keep.any():
                yield batch.filter(pa.array(keep))

    return streamed(rows, read, rows.schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)
