"""SimHash near-dedup with a self-join of binary tries.

``near_duplicates`` links equal or nearly equal fingerprints. ``without_near_copies`` takes such links as candidates
only and compares the sets of shingles themselves.

A fingerprint bit is 1 when it is set in more than half of a text's shingle hashes (XXH64, seed 42;
repeats count). Two fingerprints are linked when at most ``max_diff`` bits differ.

The self-join walks pairs of trie nodes: a pair starts at the root with itself, goes to the pairs of
children, adds one for children on different sides, and ends when more than ``max_diff`` bits differ.
Spark deals the walk out. Of ``max_diff + 1`` blocks of bits, two linked fingerprints share one, so the
trie is split by the value of each block in turn; below a block, walks are independent. A block value
that more than ``SPLIT`` fingerprints share is split again into pairs of nodes some bits further down.
Where the trie uses some of the bits only, a leaf holds different fingerprints: all pairs of two near leaves
are compared by all bits, but for those connected already; a walk that stays large is dealt out as pairs of blocks.
Equal fingerprints are one node with the smallest id, so copies cost nothing. A task returns a spanning
forest of the links it finds (enough for components); ``components`` joins the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.batches import keyed_texts, mixed, slices, text_bytes, tidy
from gablework.llm.components import components
from gablework.llm.owners import arrow_schema, runs
from gablework.shared import col, is_small, lookup_join, materialize

SPLIT = 20_000
PARTS = 4  # times 64 bits: the longer fingerprints of the stage that looks for a similarity
TABLES = 12
TABLE_BITS = 27
MAX_PAIRS = 1 << 20  # node pairs walked at a time
SLACK = 2.0  # of a pair at the threshold, one in 44 differs in more bits
GROUP_SETS = 128  # sets of a block; a task compares the pairs of two blocks
GROUP_SHINGLES = 1 << 20
LEAF_PAIRS = 1 << 17  # pairs of fingerprints compared at a time
PRINTS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("print", T.BinaryType())])
NODES = T.StructType([T.StructField("walk", T.LongType()), T.StructField("side", T.IntegerType()), T.StructField("print", T.BinaryType())])
SETS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("print", T.BinaryType()),
                     T.StructField("size", T.LongType())])
UNITS = T.StructType([T.StructField("unit", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
FOREST = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words, lower case A-Z; of all words if there are fewer."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    n = max(1, len(found) - words + 1)
    ends = ends[words - 1 :] if len(found) >= words else ends[-1:]
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)), np.uint64, n)


def fingerprint(hashes: np.ndarray, parts: int = 1) -> bytes:
    """``parts`` times 64 bits, most significant bit first. Parts after the first rehash the shingles."""
    if not len(hashes):
        return bytes(8 * parts)
    out = []
    for p in range(parts):
        h = hashes if p == 0 else mixed(hashes + np.uint64(p * 0x9E3779B97F4A7C15 % (1 << 64)))
        set_bits = np.zeros(64, np.int64)
        for a in range(0, len(h), 1 << 15):  # bounded memory for long texts
            bits = np.unpackbits(h[a : a + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            set_bits += np.count_nonzero(bits, axis=0) if len(bits) < 64 else bits.sum(axis=0, dtype=np.uint32)
        out.append(np.packbits(2 * set_bits > len(h)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, words: int = 3, parts: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, print) for every row; a null text has no words and the fingerprint zero."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PRINTS)
        for batch in slices(batches):
            prints = [fingerprint(shingle_hashes(t, words), parts) for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(prints, pa.binary())], schema=schema)

    return keyed_texts(docs, id_col, text_col).mapInArrow(tidy(read), PRINTS)


class Table:
    """Which bits of a fingerprint a trie is built on, the blocks they fall into, and the budgets.

    ``max_diff`` bits of ``bits`` may differ, and ``max_total`` bits of the whole fingerprint."""

    def __init__(self, bits: np.ndarray, max_diff: int, max_total: int):
        self.bits, self.max_diff, self.max_total = bits, max_diff, max_total
        self.blocks = [b for b in np.array_split(np.arange(len(bits)), max_diff + 1) if len(b)]

    def turned(self, prints: np.ndarray, block: int) -> np.ndarray:
        """The trie's bits as 64-bit values with one block first. ``prints``: rows of 0 and 1."""
        own = self.blocks[block]
        order = self.bits[np.concatenate([own, np.setdiff1d(np.arange(len(self.bits)), own)])]
        packed = np.zeros((len(prints), 64), np.uint8)
        packed[:, : len(order)] = prints[:, order]
        return np.packbits(packed, axis=1).view(">u8").ravel().astype(np.uint64)


def near_nodes(s: int, max_diff: int) -> list[int]:
    """All patterns of ``s`` bits with at most ``max_diff`` ones."""
    return [sum(1 << b for b in c) for k in range(max_diff + 1) for c in combinations(range(s), k)]


def node_rows(prints: DataFrame, tables: list[Table], sizes: DataFrame | None) -> DataFrame:
    """Every fingerprint under the walks it takes part in; see the module text. ``sizes``: (walk, n) of large walks."""
    width = 8 * 8 * 64

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(NODES)
        for batch in batches:
            raw = batch.column("print").to_pylist()
            if not raw:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1)
            for t, table in enumerate(tables):
                for b, own in enumerate(table.blocks):
                    head = table.turned(bits, b) >> np.uint64(64 - len(own))
                    walk = mixed(head * np.uint64(width) + np.uint64(t * 64 + b + 1)).view(np.int64)
                    side = np.full(len(raw), t * 64 + b, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(walk), pa.array(side), batch.column("print")], schema=schema)

    rows = prints.select("print").mapInArrow(plain, NODES)
    if sizes is None:
        return rows

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Large walks: rows go to the pairs (a, b), a <= b, of nodes ``s`` bits below the block."""
        schema = arrow_schema(NODES)
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            walks, sides, raw, n = (batch.column(c).to_pylist() for c in ("walk", "side", "print", "n"))
            for walk, side, p, size in zip(walks, sides, raw, n, strict=True):
                if size is None:
                    places = [walk]
                else:
                    table, block = tables[side // 64], side % 64
                    head = len(table.blocks[block])
                    s = min(len(table.bits) - head, int(size // SPLIT).bit_length() + 1)
                    value = int(table.turned(np.unpackbits(np.frombuffer(p, np.uint8))[None, :], block)[0])
                    node = value >> (64 - head - s) & ((1 << s) - 1)
                    pairs = [(min(node, node ^ x), max(node, node ^ x)) for x in near_nodes(s, table.max_diff)]
                    places = [xxhash.xxh64_intdigest(f"{walk} {a} {b}") - (1 << 63) for a, b in pairs]
                out[0].extend(places)
                out[1].extend([side] * len(places))
                out[2].extend([p] * len(places))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return lookup_join(rows, sizes, ["walk"], kept=True).mapInArrow(split, NODES)


def in_blocks(rows: DataFrame, split: int) -> DataFrame:
    """Walks that stay large, because their fingerprints agree in the bits of the trie, are dealt out as pairs of blocks."""
    rows = materialize(rows, "nodes")
    large = rows.groupBy("walk").agg(F.ceil(F.count(F.lit(1)) / split).cast("int").alias("blocks")).where("blocks > 1")
    side = materialize(large, "blocks")
    if side.isEmpty():
        return rows
    own = F.pmod(F.xxhash64("print", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    dealt = lookup_join(rows, side, ["walk"], kept=True).withColumn("own", own).withColumn("other", other)
    walk = F.when(F.col("blocks").isNull(), F.col("walk")).otherwise(F.xxhash64("walk", F.least("own", "other"), F.greatest("own", "other")))
    return dealt.select(walk.alias("walk"), "side", "print")


def walk_tries(values: np.ndarray, groups: np.ndarray, bits: int, max_diff: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of leaves (first and end of one, first and end of the other) whose values differ in at most
    ``max_diff`` of the first ``bits`` bits; a leaf of several places is paired with itself too.

    ``values`` are sorted within each group; a group is one trie. A leaf's values agree in these bits only."""
    n = len(values)
    starts = runs(groups)
    ends = np.append(starts[1:], n)
    if bits < 64:
        values = values >> np.uint64(64 - bits) << np.uint64(64 - bits)
    todo = [(0, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    while todo:
        depth, alo, ahi, blo, bhi, diff = todo.pop()
        same = alo == blo
        alone = same & (ahi - alo < 2)
        alo, ahi, blo, bhi, diff, same = (x[~alone] for x in (alo, ahi, blo, bhi, diff, same))
        if not len(alo):
            continue
        if len(alo) > MAX_PAIRS:
            half = len(alo) // 2
            todo.append((depth, alo[:half], ahi[:half], blo[:half], bhi[:half], diff[:half]))
            todo.append((depth, alo[half:], ahi[half:], blo[half:], bhi[half:], diff[half:]))
            continue
        if depth == bits:
            yield alo, ahi, blo, bhi
            continue
        bit = (values >> np.uint64(63 - depth) & np.uint64(1)).astype(np.int32) if n < 4 * len(alo) else None
        if bit is not None:
            ones = np.append(0, np.cumsum(bit))
            amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        else:
            amid, bmid = (middle(values, lo, hi, depth) for lo, hi in ((alo, ahi), (blo, bhi)))
        parts = [
            (alo, amid, blo, bmid, diff, np.ones(len(alo), bool)),
            (amid, ahi, bmid, bhi, diff, np.ones(len(alo), bool)),
            (alo, amid, bmid, bhi, diff + 1, np.ones(len(alo), bool)),
            (amid, ahi, blo, bmid, diff + 1, ~same),
        ]
        kept = [[x[ok & (p[1] > p[0]) & (p[3] > p[2]) & (p[4] <= max_diff)] for x in p[:5]] for p in parts for ok in [p[5]]]
        todo.append((depth + 1, *(np.concatenate(c) for c in zip(*kept, strict=True))))


def middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at ``depth`` turns to 1 in each sorted range, by halving all ranges together."""
    lo, hi = lo.copy(), hi.copy()
    shift = np.uint64(63 - depth)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = (values[np.minimum(mid, len(values) - 1)] >> shift & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest place connected to each place."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        differ = a != b
        if not differ.any():
            break
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def leaf_pairs(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places of each pair of leaves, each pair once, about ``LEAF_PAIRS`` at a time."""
    n = (ahi - alo) * (bhi - blo)
    part = (np.cumsum(n) - n) // LEAF_PAIRS
    cuts = np.append(runs(part), len(n))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        size = n[lo:hi]
        leaf = np.repeat(np.arange(lo, hi), size)
        nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = (bhi - blo)[leaf]
        u, v = alo[leaf] + nth // width, blo[leaf] + nth % width
        once = (alo != blo)[leaf] | (u < v)
        yield u[once], v[once]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def large_leaves(a: np.ndarray, b: np.ndarray, data: np.ndarray, root: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``most`` bits connect between the places ``a`` and ``b`` (the same for a leaf with
    itself). Every pair is compared unless its places are connected already."""
    same = a[0] == b[0]
    members = a if same else np.concatenate([a, b])
    label = np.unique(root[members], return_inverse=True)[1]
    prints, u, v = data[members], [], []
    for i in range(len(a)):
        start = i + 1 if same else len(a)
        open_ = start + np.flatnonzero(label[start:] != label[i])
        near = open_[distances(prints[open_], prints[i]) <= most] if len(open_) else open_
        if len(near):
            u.append(np.full(len(near), members[i]))
            v.append(members[near])
            label[np.isin(label, label[near])] = label[i]
            if (label == label[0]).all():
                break
    return (np.concatenate(u), np.concatenate(v)) if u else (members[:0], members[:0])


def linked(rows: DataFrame, tables: list[Table]) -> DataFrame:
    """A spanning forest (u, v) of the links within every walk."""

    def settle(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(chunk).combine_chunks()
        walk, side = whole.column("walk").to_numpy(), whole.column("side").to_numpy()
        raw = np.array(whole.column("print").to_pylist(), dtype=object)
        size = np.diff(np.append(runs(walk, side), len(walk)))
        several = np.repeat(size > 1, size)
        if not several.any():
            return
        walk, side, raw = walk[several], side[several], raw[several]
        starts = runs(walk, side)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(walk))))
        data = np.frombuffer(b"".join(raw.tolist()), np.uint8).reshape(len(raw), -1)
        found_u, found_v = [], []
        for s in np.unique(side):
            table, mine = tables[s // 64], np.flatnonzero(side == s)
            values = table.turned(np.unpackbits(data[mine], axis=1), int(s % 64))
            order = np.lexsort((values, group[mine]))
            mine, values = mine[order], values[order]
            local = np.arange(len(mine))
            root = local.copy()
            own = data[mine]

            def join(u: np.ndarray, v: np.ndarray, root: np.ndarray, local: np.ndarray = local) -> np.ndarray:
                return forest(len(local), np.concatenate([local, u]), np.concatenate([root, v])) if len(u) else root

            for alo, ahi, blo, bhi in walk_tries(values, group[mine], len(table.bits), table.max_diff):
                large = (ahi - alo) * (bhi - blo) > LEAF_PAIRS
                for u, v in leaf_pairs(alo[~large], ahi[~large], blo[~large], bhi[~large]):
                    apart = root[u] != root[v]
                    u, v = u[apart], v[apart]
                    near = distances(own[u], own[v]) <= table.max_total
                    root = join(u[near], v[near], root)
                for i in np.flatnonzero(large):
                    u, v = large_leaves(np.arange(alo[i], ahi[i]), np.arange(blo[i], bhi[i]), own, root, table.max_total)
                    root = join(u, v, root)
            found_u.append(mine[root != local])
            found_v.append(mine[root[root != local]])
        u, v = np.concatenate(found_u), np.concatenate(found_v)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(raw[u].tolist(), pa.binary()), pa.array(raw[v].tolist(), pa.binary())],
                                             schema=arrow_schema(FOREST))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk.append(batch)
            size += batch.num_rows
            if size < 100_000:
                continue
            whole = pa.Table.from_batches(chunk).combine_chunks()
            walk = whole.column("walk").to_numpy()
            cut = int(np.searchsorted(walk, walk[-1]))
            if cut:
                yield from settle(whole.slice(0, cut).to_batches())
            chunk = whole.slice(cut).to_batches()
            size = whole.num_rows - cut if cut else 0
        if chunk:
            yield from settle(chunk)

    return rows.repartition("walk").sortWithinPartitions("walk", "side").mapInArrow(tidy(read), FOREST)


def near_links(prints: DataFrame, tables: list[Table], split: int = SPLIT) -> DataFrame:
    """Links (u, v) between different fingerprints of ``prints`` (one row each), as spanning forests."""
    rows = node_rows(prints, tables, None)
    large = materialize(rows.groupBy("walk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split), "walks")
    if not large.isEmpty():
        rows = in_blocks(node_rows(prints, tables, large), split)
    return linked(rows, tables)


def classes(prints: DataFrame, tables: list[Table], split: int = SPLIT) -> DataFrame:
    """(doc, print, component): the smallest id reachable over links. Rows without id have no component
    of their own making: they get that of their fingerprint."""
    prints = materialize(prints, "prints")
    distinct = materialize(prints.groupBy("print").agg(F.min("doc").alias("smallest")), "distinct")
    roots = components(near_links(distinct, tables, split))
    named = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    ids = named.groupBy("root").agg(F.min("smallest").alias("component"))
    of_print = named.join(ids, "root").select("print", "component")
    return lookup_join(prints, of_print, ["print"])


def whole_table(bits: int = 64, max_diff: int = 2) -> list[Table]:
    return [Table(np.arange(bits), max_diff, max_diff)]


def tables_for(similarity: float, parts: int = PARTS, tables: int = TABLES, bits: int = TABLE_BITS, seed: int = 11,
               slack: float = 0.0) -> list[Table]:
    """Tries on several subsets of the bits, each with two differing bits at most: two texts whose shingle sets
    have a Jaccard similarity of 0.8 meet in one of them with probability 0.93, of 0.85 with 0.98. Found pairs are
    linked when the whole fingerprints differ in no more bits than ``similarity`` lets expect, and ``slack`` standard deviations."""
    rng = np.random.default_rng(seed)
    cosine = 2 * similarity / (1 + similarity)
    share = np.arccos(cosine) / np.pi
    most = int(64 * parts * share + slack * np.sqrt(64 * parts * share * (1 - share)))
    return [Table(np.sort(rng.choice(64 * parts, bits, replace=False)), 2, most) for _ in range(tables)]


def shingle_set(text: bytes | None, words: int) -> tuple[bytes, np.ndarray]:
    """A key that equal sets share, and the sorted hashes of the different shingles."""
    found = np.unique(shingle_hashes(text, words))
    return xxhash.xxh3_128_digest(found.tobytes()), found


def set_rows(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, print, size) for every row: its shingle set's key, fingerprint (a shingle counts once) and size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SETS)
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([k for k, _ in sets], pa.binary()),
                                              pa.array([fingerprint(h, PARTS) for _, h in sets], pa.binary()),
                                              pa.array([len(h) for _, h in sets], pa.int64())], schema=schema)

    return keyed_texts(docs, id_col, text_col).mapInArrow(tidy(read), SETS)


def similar_sets(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the sets that pairs of at least ``similarity`` (Jaccard) connect. Every pair is compared
    unless its sets are connected already or their sizes rule it out."""
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    postings = owner[order]
    token = np.cumsum(np.append(0, np.diff(values[order]) != 0)) if len(values) else values
    starts = np.append(runs(token), len(token))
    of_place = np.empty(len(values), np.int64)
    of_place[order] = token
    ends = np.cumsum(size)
    label, u, v = np.arange(n), [], []
    for i in range(n - 1):
        later = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        later = later[np.minimum(size[later], size[i]) >= similarity * np.maximum(size[later], size[i]) - 1e-9]
        if not len(later):
            continue
        mine = of_place[ends[i] - size[i] : ends[i]]
        if len(later) <= 4:
            common = np.array([np.isin(of_place[ends[j] - size[j] : ends[j]], mine, assume_unique=True).sum() for j in later.tolist()])
        else:
            lo, count = starts[mine], starts[mine + 1] - starts[mine]
            at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            common = np.bincount(postings[at], minlength=n)[later]
        near = later[common >= similarity * (size[i] + size[later] - common) - 1e-9]
        if len(near):
            u.append(np.full(len(near), i))
            v.append(near)
            label[np.isin(label, label[near])] = label[i]
    none = np.zeros(0, np.int64)
    return (np.concatenate(u), np.concatenate(v)) if u else (none, none)


def verified_links(docs: DataFrame, members: DataFrame, words: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) between keys of shingle sets of at least ``similarity``, within each candidate group, as spanning forests.

    ``members``: (doc, key, size, group), one row per set. A group of more than ``GROUP_SETS`` sets or
    ``GROUP_SHINGLES`` shingles is dealt out as pairs of blocks, so that every pair meets in a task."""
    total = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles")).where("n > 1")
    blocks = total.select("group", F.greatest(F.ceil(F.col("n") / GROUP_SETS), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("int").alias("blocks"))
    wanted = materialize(members.join(blocks, "group").select("doc", "key", "group", "blocks"), "members")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(UNITS)
        for batch in slices(batches, 1 << 20):
            texts = text_bytes(batch)
            keys, groups, blocks = (batch.column(c).to_pylist() for c in ("key", "group", "blocks"))
            for text, key, group, n in zip(texts, keys, groups, blocks, strict=True):
                found, shingles = shingle_set(text, words)
                if found != key:  # another row with this id
                    continue
                own = xxhash.xxh64_intdigest(key, 1) % n
                units = [xxhash.xxh64_intdigest(group + b"%d %d" % (min(own, x), max(own, x))) - (1 << 63) for x in range(n)]
                for a in range(0, n, 64):  # bounded batches
                    part = units[a : a + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([key] * len(part), pa.binary()),
                                                      pa.array([shingles.tobytes()] * len(part), pa.binary())], schema=schema)

    def settle(chunk: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = list(chunk)
        u, v = similar_sets(list(chunk.values()), similarity)
        if len(u):
            root = forest(len(keys), u, v)
            u = np.flatnonzero(root != np.arange(len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in u.tolist()], pa.binary()),
                                              pa.array([keys[i] for i in root[u].tolist()], pa.binary())], schema=arrow_schema(FOREST))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, chunk = None, {}
        for batch in batches:
            keys, sets = batch.column("key"), batch.column("shingles")
            for i, now in enumerate(batch.column("unit").to_pylist()):
                if now != unit:
                    if len(chunk) > 1:
                        yield from settle(chunk)
                    unit, chunk = now, {}
                chunk[keys[i].as_py()] = np.frombuffer(sets[i].as_py(), np.uint64)
        if len(chunk) > 1:
            yield from settle(chunk)

    plain = keyed_texts(docs, id_col, text_col)
    side = F.broadcast(wanted) if is_small(wanted) else wanted
    units = plain.join(side, "doc").mapInArrow(tidy(read), UNITS)
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(tidy(verify), FOREST)


def similar_classes(docs: DataFrame, words: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, component) for every row; all rows have ids. Rows are linked when the Jaccard similarity of their sets
    of shingles is at least ``similarity``. Fingerprints only choose which texts are compared: those that links of
    ``SLACK`` standard deviations more than expected connect."""
    rows = materialize(set_rows(docs, words, id_col, text_col), "sets")
    sets = materialize(rows.groupBy("key").agg(F.min("doc").alias("doc"), F.first("print").alias("print"), F.first("size").alias("size")), "distinct")
    links = near_links(sets.select("print").distinct(), tables_for(similarity, slack=SLACK))
    roots = components(links)
    groups = sets.join(roots.withColumnRenamed("node", "print"), "print", "left")
    members = groups.select("doc", "key", "size", F.coalesce("root", "print").alias("group"))
    found = components(verified_links(docs, members, words, similarity, id_col, text_col))
    named = sets.join(found.withColumnRenamed("node", "key"), "key", "left").select("key", "doc", F.coalesce("root", "key").alias("root"))
    ids = named.groupBy("root").agg(F.min("doc").alias("component"))
    return lookup_join(rows.select("doc", "key"), named.join(ids, "root").select("key", "component"), ["key"]).select("doc", "component")


def without_near_copies(docs: DataFrame, words: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class of near copies the rows of the smallest id, all columns kept; of rows with equal ids
    and texts one. Rows without id are kept, they are nobody's copy."""
    found = similar_classes(docs.where(col(id_col).isNotNull()), words, similarity, id_col, text_col)
    kept = found.select(F.col("component").alias("__kept")).distinct()
    matched = docs.join(kept, col(id_col).cast("long") == F.col("__kept"), "left_semi")
    one = Window.partitionBy(id_col, "__text").orderBy("__text")
    alone = matched.withColumn("__text", F.sha2(col(text_col), 256))
    alone = alone.withColumn("__nth", F.row_number().over(one)).where(F.col("__nth") == 1).drop("__nth", "__text")
    return alone.unionByName(docs.where(col(id_col).isNull()))


def near_duplicates(docs: DataFrame, words: int = 3, max_diff: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    split: int = SPLIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Defined results: texts without words (null, empty, white space) have fingerprint zero and are linked
    like any other. Repeated rows are rows of their own. A row with a null id gets the component of its
    fingerprint, null if no row there has an id. Other columns are not read.
    """
    found = classes(fingerprints(docs, words, 1, id_col, text_col), whole_table(64, max_diff), split)
    return found.select(F.col("doc").alias("doc_id"), F.lower(F.hex("print")).alias("fingerprint"), F.col("component").alias("component_id"))
