"""Substring dedup over bytes, by bucket-pointer refinement of a suffix array.

A byte is removed when a string of ``length`` bytes that covers it also starts in a document with a
smaller id. Suffixes of one order up to ``length`` bytes stand in one bucket; a bucket is refined by
sorting on the buckets that its suffixes' later offsets stand in.

0. Whole texts that a smaller document has too are settled by their digests and take no further part.
1. Initial buckets are q-grams. Of the suffixes, each string of ``length`` bytes needs only one with
   its anchor (smallest q-gram, by hash), so a run of neighbouring strings with one anchor is one row.
   Buckets that a single document has are final and go no further.
2. The runs left are dealt out by bucket, with their bytes. A task lays them end to end and gives
   every place its q-gram as bucket pointer. Places are sorted on (own pointer, pointer at a later offset); the refined
   buckets are written back and read by the next step: widths q, 2q, ... up to ``length``.
   After each step strings whose bucket holds one document are final and are left out.
   The anchor's own bytes are not sent: all rows of a bucket have the same.
3. The strings of a bucket of more than ``MAX_RUNS`` rows are refined in the same steps, a batch at a time, with hashes as
   bucket identifiers; the last buckets are compared as a stream, which keeps one row at a time.

Pointers are 64-bit hashes of q-grams; 2. and 3. compare within anchors' buckets.

Defined results: a null text is empty. A row with a null id is kept whole and takes no part. Rows with
equal ids are the same document. Texts shorter than ``length`` are kept. Removing bytes can cut a
character in two, so ``kept`` is binary. Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm import owners
from gablework.llm.batches import (
    Laid, anchors, covered, ids_of, keyed_texts, long_field, mixed, packed, segments, tag_of, text_bytes, tidy, unpacked,
    window_hashes,
)
from gablework.llm.owners import runs

LENGTH = 50
GRAM = 20
BLOCK = 1 << 18
BATCH = 16 << 20
MAX_RUNS = 100_000
CHUNK_BYTES = 1 << 20
GRAMS = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("gram", T.LongType())])
RUNS = T.StructType([*long_field("key", "doc", "tag", "start", "n").fields, T.StructField("cut", T.IntegerType()), T.StructField("bytes", T.BinaryType())])
FOUND = long_field("key", "doc", "tag", "start", "n")
KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()),
])
BYTE_HASHES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def blocks(texts: list[bytes | None], length: int) -> Iterator[Laid]:
    """The texts' bytes as hashed tokens, about ``BLOCK`` at a time."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        if text is None or len(text) < length:
            continue
        tokens = np.frombuffer(text, np.uint8)
        for a, b in segments(len(text), length - 1):
            parts.append((i, a, tokens[a:b]))
            size += b - a
            if size >= BLOCK:
                yield Laid(parts, length)
                parts, size = [], 0
    if parts:
        yield Laid(parts, length)


def anchored_runs(laid: Laid, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings with one anchor: first place, number of strings, the anchor's place; all q-gram hashes."""
    hashes = window_hashes(BYTE_HASHES[laid.tokens], gram)
    at = np.flatnonzero(laid.valid)
    if not len(at):
        return at, at, at, hashes
    place = anchors(hashes, length - gram + 1)[at]
    first = runs(laid.part[at], place)
    return at[first], np.diff(np.append(first, len(at))), place[first], hashes


def gram_key(h: np.ndarray) -> np.ndarray:
    """48 bits are enough to find candidates, and shorter in the shuffle; a chance match costs a comparison."""
    return owners.live_key(h >> np.uint64(16))


def find_grams(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, doc, gram): the initial bucket of every run; live rows have no ``gram`` but their key."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(GRAMS)
        for batch in without_copies(batches, BATCH):
            doc, owner, key = ids_of(batch), [], []
            for laid in blocks(text_bytes(batch), length):
                first, _, place, hashes = anchored_runs(laid, length, gram)
                owner.append(doc[laid.row(first)])
                key.append(gram_key(hashes[place]))
            if not key:
                continue
            owner, key = np.concatenate(owner), np.concatenate(key)
            once = np.lexsort((owner, key))
            once = once[runs(key[once], owner[once])]
            owner, key = owner[once], key[once]
            live, done = owners.settle_repeated(key, owner)
            known = np.concatenate([np.zeros(len(live), np.int64), key[done]])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([key[live], owners.done_key(owner[done], done)])),
                pa.array(np.concatenate([owner[live], owner[done]])),
                pa.array(known, mask=np.arange(len(known)) < len(live)),
            ], schema=schema)

    return docs.mapInArrow(tidy(read), GRAMS)


def whole_hash(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray, gram: int) -> np.ndarray:
    """A hash of slices, from the hashes of the q-grams that cover them."""
    out = mixed(sizes.astype(np.uint64) + grams[starts + sizes - gram])
    for at in range(0, int(sizes.max()) - gram + 1, gram):
        out = mixed(out + grams[starts + np.minimum(at, sizes - gram)])
    return out


def flanks(tokens: np.ndarray, starts: np.ndarray, cuts: np.ndarray, sizes: np.ndarray, gram: int) -> pa.Array:
    """Slices without the q-gram at ``cuts``, which the key stands for; no Python object per row."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(sizes - gram, out=offsets[1:])
    nth = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes - gram)
    nth += np.where(nth >= np.repeat(cuts, sizes - gram), gram, 0) + np.repeat(starts, sizes - gram)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(tokens[nth])])


def restored(rows: pa.Table, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs' bytes end to end and where each starts; the place of the q-gram is filled with the key."""
    texts = pa.concat_arrays(rows.column("bytes").chunks)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    sent = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    sizes = rows.column("n").to_numpy() + length - 1
    starts = np.cumsum(sizes) - sizes
    data, filled = np.zeros(sizes.sum(), np.uint8), np.zeros(sizes.sum(), bool)
    places = (starts + rows.column("cut").to_numpy())[:, None] + np.arange(gram)
    filled[places] = True
    data[places] = rows.column("key").to_numpy().view(np.uint8).reshape(-1, 8)[:, np.arange(gram) % 8]
    data[~filled] = sent
    return data, starts


def find_runs(docs_with_grams: DataFrame, length: int, gram: int) -> DataFrame:
    """The runs in buckets that two documents have. Equal runs of a block stay once; the others are done."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(RUNS)
        for batch in without_copies(batches, BATCH):
            texts, doc = text_bytes(batch), ids_of(batch)
            offsets = batch.column("grams").offsets.to_numpy()
            values = batch.column("grams").values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            values = np.unique(values)  # buckets of other documents in the batch do no harm
            tags = np.array([tag_of(t or b"") for t in texts], dtype=np.int64)
            found = []
            for laid in blocks(texts, length):
                first, n, place, hashes = anchored_runs(laid, length, gram)
                key = gram_key(hashes[place])
                kept = np.flatnonzero(values[np.minimum(np.searchsorted(values, key), len(values) - 1)] == key)
                if not len(kept):
                    continue
                first, n, key, place = first[kept], n[kept], key[kept], place[kept]
                same = whole_hash(hashes, first, n + length - 1, gram).view(np.int64)
                found.append((laid.tokens, first, n, key, same, laid.row(first), laid.place(first), place - first))
            if not found:
                continue
            row = np.concatenate([f[5] for f in found])
            start = np.concatenate([f[6] for f in found])
            n = np.concatenate([f[2] for f in found])
            later = np.zeros(len(row), bool)
            later[owners.settle_later(np.concatenate([f[4] for f in found]), doc[row])[1]] = True
            base = 0
            for tokens, first, n_, key, _, row_, start_, cut in found:
                live = np.flatnonzero(~later[base : base + len(first)])
                base += len(first)
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(c) for c in (key[live], doc[row_[live]], tags[row_[live]], start_[live], n_[live].astype(np.int64))],
                    pa.array(cut[live].astype(np.int32)),
                    flanks(tokens, first[live], cut[live], n_[live] + length - 1, gram),
                ], schema=schema)
            row, start, n = row[later], start[later], n[later]
            if len(row):  # neighbouring done runs become one
                new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + n[:-1]))
                first = np.flatnonzero(new)
                n = np.add.reduceat(n, first)
                row, start = row[first], start[first]
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(c) for c in (owners.done_key(doc[row], start.view(np.uint64)), doc[row], tags[row], start, n.astype(np.int64))],
                    pa.array(np.zeros(len(row), np.int32)), pa.array([b""] * len(row), pa.binary()),
                ], schema=schema)

    return docs_with_grams.mapInArrow(tidy(read), RUNS)


def widenings(length: int, gram: int) -> list[tuple[int, list[int]]]:
    """(later offset, offsets still needed) of every step: widths double up to ``length``; a step needs new pointers at
    the strings' places and at those that the steps after it will read."""
    steps, width = [], gram
    while width < length:
        steps.append(min(width, length - width))
        width += steps[-1]
    needed, out = [0], []
    for step in reversed(steps):
        out.append((step, needed))
        needed = sorted({*needed, *(o + step for o in needed)})
    return out[::-1]


def refine(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Whether the string at each place also starts in a smaller document; places are in ``data``.

    ``pointer`` holds the bucket of every place. A step sorts places on (own bucket, bucket at a later offset) and writes the
    refined buckets back, where the next step reads them."""
    pointer = window_hashes(BYTE_HASHES[data], gram)
    out, left = np.zeros(len(at), bool), np.arange(len(at))
    steps = widenings(length, gram)
    for nth in range(len(steps) + 1):
        bucket = pointer[at[left]]
        order = np.argsort(bucket)
        left, bucket = left[order], bucket[order]
        if not len(left):
            break
        starts = runs(bucket)
        sizes = np.diff(np.append(starts, len(left)))
        own = doc[left]
        smallest = np.minimum.reduceat(own, starts)
        if nth == len(steps):
            out[left] = own > np.repeat(smallest, sizes)
            break
        left = left[np.repeat(np.maximum.reduceat(own, starts) > smallest, sizes)]  # the others are final
        step, needed = steps[nth]
        wanted = np.zeros(len(pointer), bool)
        for o in needed:
            wanted[at[left] + o] = True
        places = np.flatnonzero(wanted)
        mine, later = pointer[places], pointer[places + step]
        order = np.lexsort((later, mine))
        mine, later = mine[order], later[order]
        refined = np.cumsum(np.append(False, (mine[1:] != mine[:-1]) | (later[1:] != later[:-1]))) if len(places) else places
        pointer[places[order]] = refined.astype(np.uint64)
    return out


def refined_hashes(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The same refinement where a bucket is spread over tasks: identifiers are hashes of the two that they refine."""
    pointer = window_hashes(BYTE_HASHES[data], gram)
    for step, _ in widenings(length, gram):
        pointer = mixed(mixed(pointer[: max(0, len(pointer) - step)]) + np.uint64(0x9E3779B97F4A7C15) * pointer[step:])
    return pointer


def compare_runs(rows: DataFrame, length: int, gram: int, max_runs: int = MAX_RUNS,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Spans of strings that a smaller document has (done), and the strings of huge buckets (live)."""

    def settle(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(chunk)
        data, starts = restored(table, length, gram)
        doc, tag, start, n = (table.column(c).to_numpy() for c in ("doc", "tag", "start", "n"))
        owner = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = starts[owner] + nth
        late = np.flatnonzero(refine(data, at, doc[owner], length, gram))
        if not len(late):
            return
        first = late[runs(owner[late], late - np.arange(len(late)))]
        count = np.diff(np.append(np.searchsorted(late, first), len(late)))
        yield spans(doc[owner[first]], tag[owner[first]], start[owner[first]] + nth[first], count)

    def spans(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        key = owners.done_key(doc, start.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (key, doc, tag, start, n)], schema=owners.arrow_schema(FOUND))

    def single(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, tag, start, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag", "start", "n"))
        data, starts = restored(pa.Table.from_batches([batch]), length, gram)
        owner = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        hashes = refined_hashes(data, length, gram)[starts[owner] + nth]
        live, done = owners.settle_later(owners.live_key(hashes), doc[owner])
        order = np.concatenate([live, done])
        d, s = doc[owner[order]], (start[owner] + nth)[order]
        key = np.concatenate([owners.live_key(hashes)[live], owners.done_key(d[len(live):], s[len(live):].view(np.uint64))])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (key, d, tag[owner[order]], s, np.ones(len(d), np.int64))], schema=owners.arrow_schema(FOUND))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[pa.RecordBatch] = []  # whole buckets, then the rows so far of the last one
        size = 0
        huge = None
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            done = (key & 1) == 1
            if done.any():
                ready = batch.filter(pa.array(done))
                yield spans(*(ready.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag", "start", "n")))
                batch = batch.filter(pa.array(~done))
                key = key[~done]
            if len(key) and huge is not None and key[0] == huge:
                stop = int(np.searchsorted(key, huge, side="right"))
                yield from single(batch.slice(0, stop))
                batch, key = batch.slice(stop), key[stop:]
            if not len(key):
                continue
            huge = None
            chunk.append(batch)
            size += batch.column("bytes").nbytes
            if size < chunk_bytes:
                continue
            table = pa.Table.from_batches(chunk).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from settle(table.slice(0, cut).to_batches())
            rest = table.slice(cut)
            if rest.num_rows > max_runs:
                huge = keys[-1]
                for part in rest.to_batches(max_chunksize=10_000):
                    yield from single(part)
                chunk, size = [], 0
            else:
                chunk, size = rest.to_batches(), rest.column("bytes").nbytes if not cut else 0
        if chunk:
            yield from settle(chunk)

    return owners.streamed(rows, read, FOUND)


def copies(known: DataFrame) -> DataFrame:
    """(doc, copied): digests of the texts of a document that a smaller document has as a whole."""
    marked = known.where("text IS NOT NULL").select("doc", F.unhex(F.sha2("text", 256)).alias("digest"))
    first = marked.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    found = marked.join(first, "digest").where("doc > first")
    return found.groupBy("doc").agg(F.collect_set("digest").alias("copied"))


def is_copy(text: bytes | None, copied: pa.Scalar) -> bool:
    return copied.is_valid and hashlib.sha256(text or b"").digest() in copied.as_py()


def without_copies(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(batches, limit):
        left = [not (c.is_valid and is_copy(t.as_py(), c)) for t, c in zip(batch.column("text"), batch.column("copied"), strict=True)]
        if any(left):
            yield batch if all(left) else batch.filter(pa.array(left))


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                    max_runs: int = MAX_RUNS, chunk_bytes: int = CHUNK_BYTES, carry: Sequence[str] = (), characters: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row; ``kept`` are the bytes left, in order.
    Columns named in ``carry`` come along in the struct ``carried``. ``characters``: bytes of a character that was cut in
    two are not ``kept`` either, and of a null text nothing is (null)."""
    plain = keyed_texts(docs, id_col, text_col, carry)
    known = plain.where("doc IS NOT NULL")
    out_schema = T.StructType([*KEPT.fields, *([plain.schema["carried"]] if carry else [])])
    # Used three times below; the plan keeps one exchange. Copies of whole texts are known without comparing strings.
    dealt = packed(known).repartition("doc").hint("merge").join(copies(known), "doc", "left")
    buckets = owners.repeated(find_grams(dealt, length, gram))
    grams = buckets.groupBy("doc").agg(F.collect_list(F.coalesce("gram", "key")).alias("grams"))
    found_runs = find_runs(dealt.join(grams.hint("merge"), "doc"), length, gram)
    found = owners.later(compare_runs(found_runs, length, gram, max_runs, chunk_bytes))
    removed = found.groupBy("doc").agg(F.collect_list(F.struct("tag", "start", "n")).alias("found"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = owners.arrow_schema(out_schema)
        for batch in unpacked(batches):
            spans, columns = batch.column("found"), ([], [], [], [])
            for i, text in enumerate(text_bytes(batch)):
                null, text, n_removed, n_spans = text is None, text or b"", 0, 0
                size = len(text)
                if size >= length and is_copy(text, batch.column("copied")[i]):
                    n_removed, n_spans, text = size, 1, b""
                elif spans[i].is_valid:
                    own = spans[i].values
                    tag, start, n = (own.field(c).to_numpy(zero_copy_only=False) for c in ("tag", "start", "n"))
                    mine = tag == tag_of(text)
                    gone = covered(start[mine], n[mine] + length - 1, size)
                    n_removed = int(gone.sum())
                    n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]) if size else 0
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    if characters and n_removed:
                        text = text.decode(errors="ignore").encode()
                if characters and null:
                    text = None
                for c, v in zip(columns, (size, n_removed, n_spans, text), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:5], strict=True)],
                 *([batch.column("carried")] if carry else [])], schema=schema)

    alone = plain.where("doc IS NULL").select(
        F.col("doc").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), (F.col("text").cast("binary") if characters else F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("kept"),
        *(["carried"] if carry else []))
    return dealt.join(removed.hint("merge"), "doc", "left").mapInArrow(tidy(read), out_schema).union(alone)


def cut_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts, all columns kept, ``n_chars`` brought up to date.
    Bytes of a character that was cut in two go as well. A document of which nothing is left goes; texts that
    were null or empty before stay as they are."""
    others = [c for c in docs.columns if c != text_col]
    found = without_repeats(docs, length, id_col=id_col, text_col=text_col, carry=others, characters=True)
    found = found.where((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0))
    text = F.col("kept").cast("string")
    new = {text_col: text}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length(text).cast(kind)).otherwise(F.col("carried").getField("n_chars"))
    return found.select(*[new.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns])
