"""The trie of all prefixes of rebuilt conversations.

Texts never move: a turn is its 128-bit digest (MD5 of role and text) and its number of bytes. Rebuilt conversations are
range-dealt by their whole path of digests, then by id, so each task holds a contiguous shard of the trie's
leaves, and many equal conversations are spread over shards. In a task the paths become padded matrices of turn ids
(blocks of columns, so one long conversation does not widen all rows), sorted by numpy's lexsort. The change of
each column against the row above, OR-accumulated along the row, marks where nodes start, and reduceat sums up every depth.

Nodes that hold a shard's first or last row may go on in a neighbour. Their parts are summed by path, with a correction for
each pair of neighbours: what both counted as beginning or ending, though it goes on, is taken off again.

A conversation is one row of its task (16 bytes a turn), a shard about SHARD_TURNS turns. Ids are hashed in ascending
order from the shards' pieces, as a stream, for nodes of several shards.

Turns are ordered by turn number (null first); equal numbers by digest. A null role or text counts as empty. Rows with a
null conversation id belong to no conversation and are left out. Repeated rows are turns like others. An empty
table has no nodes, not even a root. Other columns, whatever their names, are not read. Null, empty or very
long texts are turns like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gablework.llm.batches import tidy
from gablework.shared import col, materialize

SHARD_TURNS = 1 << 19
SMALLEST_SHARD = 1 << 13
COLUMNS = 64  # of a block of the padded matrix
PIECE = 1 << 16  # ids of a piece of a list that is hashed over several shards
KEPT = 8  # no conversation takes more turns than this from another
NOTHING = hashlib.sha256(b"").hexdigest()

# what a row of a task's result is
NODE, PENDING, PART, ENDS, EDGE = range(5)
FIELDS = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("piece", pa.int32()), ("ids", pa.string()), ("path", pa.binary()),
    ("sizes", pa.list_(pa.int64())),
])
RESULT = from_arrow_schema(FIELDS)
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def taken_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the one it goes back to."""
    return F.crc32(conv.cast("string").cast("binary")) % (KEPT + 1)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv, path, sizes): one row per conversation; the path holds 16 bytes a turn.

    Everything a conversation needs has the same ``home``, so one exchange (of digests) does."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    conv = col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        conv.alias("conv"), (conv - conv % 5).alias("home"),
        F.struct(col("turn").cast("long").alias("turn"), digest.alias("id"), F.octet_length(text).cast("long").alias("size")).alias("turn"),
    )
    own = turns.repartition("home").groupBy("home", "conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    head = F.max(F.when(F.col("conv") == F.col("home"), F.slice("turns", 1, KEPT))).over(Window.partitionBy("home"))  # one row has it
    both = own.select("conv", "turns", head.alias("head"), taken_turns(F.col("conv")).cast("int").alias("h"))
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    whole = both.select("conv", F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    return whole.select("conv", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


@dataclass
class Rows:
    """Conversations of one shard."""

    conv: np.ndarray
    length: np.ndarray  # turns
    start: np.ndarray  # of a row's turns among all
    turn: np.ndarray  # ids of turns in the order of their digests, from 1
    before: np.ndarray  # bytes of the row's turns before this one; one entry more than turns, per row
    before_start: np.ndarray

    def bytes_from(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Bytes of the turns at ``depth`` and below in the rows (none beyond their lengths)."""
        at = self.before_start[row]
        skipped = np.minimum(np.maximum(depth, 1) - 1, self.length[row])
        return self.before[at + self.length[row]] - self.before[at + skipped]


def rows_of(conv: np.ndarray, paths: list[bytes], sizes: np.ndarray) -> Rows:
    length = np.array([len(p) for p in paths], np.int64) // 16
    ids = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2)
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    turn = np.zeros(len(ids), np.int64)
    if len(ids):
        new = np.append(True, (ids[order[1:]] != ids[order[:-1]]).any(axis=1))
        turn[order] = np.cumsum(new)
    start = np.cumsum(length) - length
    before_start = start + np.arange(len(length))
    before = np.zeros(len(turn) + len(length), np.int64)
    running = np.cumsum(sizes)
    inside = np.arange(len(turn)) + np.repeat(np.arange(len(length)), length) + 1
    before[inside] = running - np.repeat(np.append(0, running)[start], length)
    return Rows(conv, length, start, turn, before, before_start)


@dataclass
class Block:
    """Padded turn ids of the rows that reach into one block of columns, in order."""

    first: int  # depth of the first column, less one
    place: np.ndarray  # where the rows stand in the order of the shard
    ids: np.ndarray
    starts: np.ndarray  # marks: a node starts here


def ordered(rows: Rows) -> tuple[np.ndarray, np.ndarray, list[Block]]:
    """(order, shared, blocks): the rows by path, then by id; how many turns each shares with the row above."""
    order = np.lexsort((rows.conv, rows.length > 0))
    shared = np.zeros(len(order), np.int64)
    shared[0] = -1
    blocks: list[Block] = []
    first, place = 0, np.flatnonzero(rows.length[order] > 0)
    group = np.zeros(len(place), np.int64)  # equal so far
    while len(place):
        alive = order[place]
        width = int(min(COLUMNS, rows.length[alive].max() - first))
        cells = first + np.arange(width)
        at = rows.start[alive][:, None] + np.minimum(cells, rows.length[alive][:, None] - 1)
        ids = np.where(cells < rows.length[alive][:, None], rows.turn[at], 0)
        goes_on = rows.length[alive] > first + width
        by = np.lexsort((rows.conv[alive], goes_on, *ids.T[::-1], group))
        ids, alive, group, goes_on = ids[by], alive[by], group[by], goes_on[by]
        order[place] = alive
        change = np.empty((len(place), width + 1), bool)
        change[0] = True
        change[1:, 0] = group[1:] != group[:-1]
        change[1:, 1:] = ids[1:] != ids[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        follows = np.flatnonzero(~change[:, 0])
        equal = first + (~change[follows, 1:]).sum(axis=1)
        shared[place[follows]] = np.minimum(equal, np.minimum(rows.length[alive[follows]], rows.length[alive[follows - 1]]))
        blocks.append(Block(first, place, ids, change[:, 1:]))
        group = np.cumsum(change[:, -1])[goes_on]
        place, first = place[goes_on], first + width
    return order, shared, blocks


def prefix_keys(path: bytes) -> list[bytes]:
    """A name for each prefix of a path, from the root on."""
    so_far, out = hashlib.md5(), []
    for d in range(0, len(path) + 16, 16):
        out.append(so_far.digest())
        so_far.update(path[d : d + 16])
    return out


class Shard:
    """The nodes of one shard: whole ones, and parts of those that may go on in a neighbour."""

    def __init__(self, number: int, conv: np.ndarray, paths: list[bytes], sizes: np.ndarray):
        self.number, self.rows = number, rows_of(conv, paths, sizes)
        self.order, self.shared, self.blocks = ordered(self.rows)
        self.conv, self.length = conv[self.order], self.rows.length[self.order]
        self.ends_leaf = np.append(self.shared[1:], -1) < self.length
        self.names = np.array([str(c) for c in self.conv.tolist()], object)
        self.edges = [paths[e] for e in (self.order[0], self.order[-1])]
        self.keys = [prefix_keys(p) for p in self.edges]
        # of the node above, by place in the order: its least member, and the end of the shard it touches (-1: none)
        self.least, self.touched = np.empty(len(conv), np.int64), np.full(len(conv), -1, np.int64)

    def results(self) -> Iterator[pa.RecordBatch]:
        everything = np.arange(len(self.conv))
        yield from self.nodes(0, everything, np.zeros(1, np.int64))
        for b in self.blocks:
            for j in range(b.ids.shape[1]):
                here = np.flatnonzero(b.ids[:, j])
                if len(here):
                    yield from self.nodes(b.first + j + 1, b.place[here], np.flatnonzero(b.starts[here, j]))
        sizes = [self.sizes_of(e) for e in (self.order[0], self.order[-1])]
        yield result(self.number, EDGE, 2, piece=[0, 1], path=self.edges, sizes=sizes)

    def sizes_of(self, row: int) -> list[int]:
        at = self.rows.before_start[row]
        return np.diff(self.rows.before[at : at + self.rows.length[row] + 1]).tolist()

    def nodes(self, depth: int, place: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The nodes of one depth: ``place`` are the rows that reach it, ``starts`` where nodes begin among them."""
        row, shared, length = self.order[place], self.shared[place], self.length[place]

        def total(v: np.ndarray) -> np.ndarray:
            return np.add.reduceat(v.astype(np.int64), starts)

        sizes = np.diff(np.append(starts, len(place)))
        stops = starts + sizes
        least = np.minimum.reduceat(self.conv[place], starts)
        ended = total(length == depth)  # shorter rows come first in a node
        again = self.rows.bytes_from(row, np.full(len(row), depth)) - self.rows.bytes_from(row, np.maximum(depth, shared + 1))
        touches = np.where(place[starts] == 0, 0, np.where(place[stops - 1] == len(self.conv) - 1, 1, -1))
        above, parent = self.touched[place[starts]], self.least[place[starts]]
        counts = {
            "conv_id": least, "depth": np.full(len(starts), depth), "n_convs": sizes, "n_children": total((length > depth) & (shared <= depth)),
            "n_leaves": total(self.ends_leaf[place]), "saved_tokens": total(again),
        }

        def members(i: int) -> np.ndarray:
            return self.names[place[starts[i] : starts[i] + ended[i]]]

        def some(which: np.ndarray) -> dict[str, np.ndarray]:
            return {name: values[which] for name, values in counts.items()}

        for kind, which in ((NODE, (touches < 0) & (above < 0)), (PENDING, (touches < 0) & (above >= 0))):
            which = np.flatnonzero(which)
            if len(which):
                hashes = [hashlib.sha256(",".join(members(i)).encode()).hexdigest() if ended[i] else NOTHING for i in which.tolist()]
                of_parent = {"parent_conv_id": parent[which]} if kind == NODE else {"parent_key": [self.keys[t][depth - 1] for t in above[which]]}
                yield result(self.number, kind, len(which), **some(which), **of_parent, ends_sha256=hashes)
        for i in np.flatnonzero(touches >= 0).tolist():  # two at most
            keys = self.keys[touches[i]]
            yield result(self.number, PART, 1, **some(np.array([i])), key=[keys[depth]], parent_key=[keys[depth - 1] if depth else None])
            for piece, a in enumerate(range(0, ended[i], PIECE)):
                yield result(self.number, ENDS, 1, key=[keys[depth]], piece=[piece], ids=[",".join(members(i)[a : a + PIECE])])
        self.least[place], self.touched[place] = np.repeat(least, sizes), np.repeat(touches, sizes)


def result(shard: int, kind: int, n: int, **columns) -> pa.RecordBatch:
    columns |= {"kind": np.full(n, kind), "shard": np.full(n, shard)}
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in FIELDS], schema=FIELDS)


def shards(whole: DataFrame) -> DataFrame:
    """The result rows of all shards of a written table of rebuilt conversations."""
    cells = whole.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    spread = min(whole.sparkSession.sparkContext.defaultParallelism, -(-cells // SMALLEST_SHARD))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            sizes = t.column("sizes").combine_chunks().flatten().to_numpy()
            conv, paths = t.column("conv").to_numpy(), t.column("path").to_pylist()
            yield from Shard(TaskContext.get().partitionId(), conv, paths, sizes).results()

    dealt = whole.repartitionByRange(max(1, spread, -(-cells // SHARD_TURNS)), "path", "conv")
    return dealt.mapInArrow(tidy(read), RESULT)


def corrections(edges: DataFrame) -> DataFrame:
    """What two neighbours both counted of the nodes that the last row of one shares with the first of the other."""
    numbers = edges.select("shard").distinct()  # one small number per shard
    pairs = numbers.select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next")).where("next IS NOT NULL")
    last = edges.where("piece = 1").select("shard", "path", "sizes")
    first = edges.where("piece = 0").select(F.col("shard").alias("next"), F.col("path").alias("other"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, other, sizes in zip(*(batch.column(c).to_pylist() for c in ("path", "other", "sizes"))):
                n = min(len(path), len(other)) // 16
                a, b = (np.frombuffer(p[: 16 * n], ">u8").reshape(-1, 2) for p in (path, other))
                differ = np.flatnonzero((a != b).any(axis=1))
                same = int(differ[0]) if len(differ) else n
                below = np.append(np.cumsum(sizes[:same][::-1], dtype=np.int64)[::-1], 0)  # bytes of the shared turns after each
                keys = prefix_keys(path[: 16 * same])
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys, pa.binary()), "n_children": pa.array([-1] * same + [0], pa.int64()),
                    "n_leaves": pa.array([-1 if 16 * same == len(path) else 0] * (same + 1), pa.int64()),
                    "saved_tokens": pa.array(np.append(below[0], below[:-1]) if same else below, pa.int64()),
                })

    both = pairs.join(last, "shard").join(first, "next").select("path", "other", "sizes")
    return both.mapInArrow(read, "key binary, n_children long, n_leaves long, saved_tokens long")


def joined_hashes(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256): pieces of a list in the order of the shards, hashed as a stream."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, running.hexdigest()))
                    now, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield as_hashes(done)
        if now is not None:
            yield as_hashes([(now, running.hexdigest())])

    dealt = pieces.select("key", "shard", "piece", "ids").repartition("key").sortWithinPartitions("key", "shard", "piece")
    return dealt.mapInArrow(read, "key binary, ends_sha256 string")


def as_hashes(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], ["key", "ends_sha256"])


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    found = materialize(shards(materialize(rebuilt(conversations), "rebuilt")), "nodes", by="kind")
    parts = found.where(F.col("kind") == PART)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("parent_key", "binary"), ("conv_id", "long"), ("depth", "long"))]
    fixes = corrections(found.where(F.col("kind") == EDGE)).select(
        "key", *nothing, F.lit(0).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens"
    )
    summed = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    whole = parts.select(*fixes.columns).unionByName(fixes).groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in summed]
    )
    ends = joined_hashes(found.where(F.col("kind") == ENDS))
    whole = materialize(whole.join(ends, "key", "left"), "edges")  # rows: two per shard and depth at most
    least = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    wide = whole.join(least, "parent_key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    # a node that all shards share has a row in each, so nodes look for their parents in their own shard
    local = parts.select("shard", F.col("key").alias("parent_key")).join(least, "parent_key")
    pending = found.where(F.col("kind") == PENDING).drop("parent_conv_id").join(local, ["shard", "parent_key"])
    plain = found.where(F.col("kind") == NODE)
    return plain.select(*NODES).unionByName(pending.select(*NODES)).unionByName(wide.select(*NODES))


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: each byte is mixed in, then shifted out bit by bit (fixed value: the polynomial)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_concat([CAST(ascii(c) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), lambda a, x: {step}), 4294967295)"


def nodes_sql() -> str:
    return f"""WITH t AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS b, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, any_value(b) AS b, {crc32_sql("CAST(c AS VARCHAR)")} % {KEPT + 1} AS h FROM t GROUP BY c),
r AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM (
  SELECT h.c, 0 AS part, t.i, role, text FROM h JOIN t ON t.c = h.b AND t.i <= h.h
  UNION ALL SELECT h.c, 1, t.i, role, text FROM h JOIN t ON t.c = h.c AND t.i > h.h)),
m AS (SELECT c, d, strlen(text) AS size, list({{'role': role, 'text': text}}) OVER (PARTITION BY c ORDER BY d) AS path FROM r
  UNION ALL SELECT c, 0, 0, [] FROM h),
n AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM m GROUP BY path, d),
member AS (SELECT n.conv_id, n.d, m.c FROM n JOIN m ON m.d = n.d AND m.path = n.path),
k AS (SELECT n.conv_id, n.d, p.conv_id AS parent FROM n JOIN member p ON p.d = n.d - 1 AND p.c = n.conv_id),
kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM k GROUP BY 1, 2),
sub AS (SELECT a.conv_id, a.d, count(*) FILTER (kids.n_children IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.size) AS saved
  FROM member a JOIN n x ON x.conv_id = a.c AND x.d >= a.d LEFT JOIN kids ON kids.conv_id = x.conv_id AND kids.d = x.d GROUP BY 1, 2),
top AS (SELECT c, max(d) AS d FROM m GROUP BY c),
ends AS (SELECT a.conv_id, a.d, string_agg(CAST(a.c AS VARCHAR), ',' ORDER BY a.c) AS names FROM member a JOIN top USING (c, d) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, k.parent AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, sub.n_leaves,
  CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.names, '')) AS ends_sha256
FROM n LEFT JOIN k ON k.conv_id = n.conv_id AND k.d = n.d LEFT JOIN kids ON kids.conv_id = n.conv_id AND kids.d = n.d
JOIN sub ON sub.conv_id = n.conv_id AND sub.d = n.d LEFT JOIN ends ON ends.conv_id = n.conv_id AND ends.d = n.d"""
