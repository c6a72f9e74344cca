"""Log-probabilities of texts under a language model over subword ids, beside a word-count base line.

Tokens are words (A-Z in lower case, separated by ASCII white space) and one end per text. A word is a row of
subword ids of a public vocabulary. Its first id is predicted by causal self-attention over the first ids
before it (``attention``): the model gives the id's class, corpus counts give the id in its class. Given the
first id, the rest of the word follows corpus counts: of the word itself, and of the chain of its further ids,
each given the one before. All counts and classes come from all training texts. So do the attention weights: from a start
that was fitted on at most ``SAMPLE_TEXTS`` of them, each task learns from every block of its training texts, and what the
tasks learned is averaged, by symbol.

Score and base line need the count of every word and pair of ids. The ``LISTED`` most frequent words and ``PAIRS``
pairs go to the tasks, bounded tables that save work and decide no result; the others are joined by shuffle.

Defined results: a null text is empty and has the end alone. Rows without id are scored, not learned from,
and not held out. Repeated rows are rows of their own. Other columns are not read. Without any training text
N and V are 0 and the model is uniform over the vocabulary's ids.
"""

from __future__ import annotations

import ctypes
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.attention import Attention, Learner, averaged
from gablework.llm.batches import keyed_texts, per_worker, shipped, slices, tidy
from gablework.llm.owners import arrow_schema
from gablework.llm.piece_model import read_ranks, shared_file
from gablework.operators.gram import summed
from gablework.shared import col, materialize

LISTED = 200_000
LISTED_BYTES = 64  # longer words are never listed, which bounds the list
PAIRS = 300_000  # subword pairs whose counts go to the tasks; others are joined
SAMPLE_TEXTS = 3000  # whole, in pieces; the attention's start is fitted on at most twice as many pieces
SAMPLE_WORDS = 2000  # of a piece
CLASSES = 96
SYMBOLS = 3000  # first ids with rows of their own in the attention tables; others share their class's row
STEPS = 1200
GAPS = (1, 2, 3, 4, 5, 6)  # distances at which an id's neighbours are counted
AT_ONCE = 1 << 18  # tokens that a task learns from together
COUNTED_BYTES = 16 << 20  # texts whose words are counted together
OTHER_SPACES = re.compile(r"[^\S ]")
CHUNK = 1 << 14  # numbers of one summed vector
DISCOUNT = 0.7  # taken from the count of every word, for words never seen
WORD_COUNTS = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
ID_COUNTS = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])
CHAINS = T.StructType([
    T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("first", T.IntegerType()),
    T.StructField("own", T.DoubleType()), T.StructField("left", T.DoubleType()), T.StructField("chain", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                                    T.StructField("more", T.DoubleType()), T.StructField("total", T.DoubleType())]))),
])
READ = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("row", T.LongType()), T.StructField("learned", T.BooleanType()),
    T.StructField("firsts", T.ArrayType(T.IntegerType())), T.StructField("n_listed", T.LongType()),
    T.StructField("base_listed", T.DoubleType()), T.StructField("rest_listed", T.DoubleType()),
    T.StructField("others", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))),
])
SCORED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("n_listed", T.LongType()), T.StructField("base_listed", T.DoubleType()), T.StructField("score", T.DoubleType()),
])


def held_out(key: str, parts: int = 7, part: int = 2):
    return F.coalesce(F.crc32(col(key).cast("string")) % parts == part, F.lit(False))


class Subwords:
    """Subword ids of words, each with a space before it as in running text."""

    def __init__(self, file: bytes, pattern: str):
        import tiktoken

        ranks = read_ranks(file)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = len(ranks)
        self.leads = np.zeros(max(ranks.values()) + 1, bool)  # ids that begin with a space
        self.leads[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        # A space cuts every match of a pattern of words and single spaces, so that words are encoded together.
        probe = ["a", "'s", "x1-2", "é.", "!?", "12", "a'll", "中"]
        self.together = self.joined(probe)[0].tolist() == self.single(probe)[0].tolist()

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.encoding.encode_to_numpy(" " + " ".join(words)).astype(np.int64)
        starts = np.flatnonzero(self.leads[ids])
        return ids, np.diff(np.append(starts, len(ids)))

    def single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.encoding.encode_ordinary(" " + w) for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int64, int(sizes.sum())), sizes

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one word after the other, and the number of ids of each word."""
        if not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words = words.cast(pa.string()).to_pylist()
        if not self.together:
            return self.single(words)
        odd = np.zeros(len(words), bool)
        if OTHER_SPACES.search("".join(words)):  # white space inside of words can meet the space before a word
            odd[:] = [bool(OTHER_SPACES.search(w)) for w in words]
        if not odd.any():
            return self.joined(words)
        order = np.argsort(odd, kind="stable")
        n = len(words) - int(odd.sum())
        parts = [f([words[i] for i in x.tolist()]) for f, x in ((self.joined, order[:n]), (self.single, order[n:])) if len(x)]
        ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        place = np.argsort(order, kind="stable")  # back to the order of the words
        begin, out = (np.cumsum(sizes) - sizes)[place], sizes[place]
        return ids[np.repeat(begin - np.cumsum(out) + out, out) + np.arange(len(ids))], out


def subwords_of(file: bytes, pattern: str) -> Subwords:
    """One per Python worker: its tables take longer to make than a batch takes to encode."""
    return per_worker(f"subwords_{zlib.crc32(file + pattern.encode()):08x}", lambda: Subwords(file, pattern))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one text after the other, and the number of each text's. A-Z are in lower case."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = parts.flatten()
    there = np.diff(np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)) > 0  # none before the first and after the last
    sizes = np.diff(np.append(0, np.cumsum(there))[parts.offsets.to_numpy() - parts.offsets[0].as_py()])
    return words if there.all() else words.filter(pa.array(there)), sizes


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts; every task sums up before the shuffle."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(WORD_COUNTS)
        for batch in slices(batches, COUNTED_BYTES):
            found = pc.value_counts(words_of(batch.column("text"))[0])
            for a in range(0, len(found), 20_000):
                part = found[a : a + 20_000].flatten()
                yield pa.RecordBatch.from_arrays([part[0].cast(pa.binary()), part[1]], schema=schema)

    return train.select("text").mapInArrow(tidy(read), WORD_COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(counts: DataFrame, file, pattern: str) -> DataFrame:
    """(a, b, n): in how many different words id b follows id a; b = -1 after the last. With a = -1: how many
    tokens begin with id b, with a = -2 how many different words. Chains are needed for rare words, so they are
    learned from words, not from tokens."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, found = subwords_of(file.value, pattern), None
        for batch in slices(batches, 1 << 20, "word"):
            ids, sizes = subwords(batch.column("word"))
            starts = np.cumsum(sizes + 1) - sizes - 1
            n = np.ones(int((sizes + 1).sum()), np.int64)
            n[starts] = batch.column("n").to_numpy(zero_copy_only=False)
            ends = starts + sizes
            b = np.full(len(n), -1, np.int64)
            inner = np.ones(len(n), bool)
            inner[ends] = False
            b[inner] = ids
            a = np.append(-1, b[:-1])
            code = (a + 2) * (subwords.size + 2) + b + 1
            code, n = np.append(code, b[starts] + 1), np.append(n, np.ones(len(starts), np.int64))
            key, place = np.unique(code, return_inverse=True)
            part = np.stack([key, np.bincount(place, weights=n).astype(np.int64)])
            if found is None:
                found = part
            else:
                key, place = np.unique(np.concatenate([found[0], part[0]]), return_inverse=True)
                found = np.stack([key, np.bincount(place, weights=np.concatenate([found[1], part[1]])).astype(np.int64)])
        if found is not None:
            a, b = np.divmod(found[0], subwords.size + 2)
            yield pa.RecordBatch.from_arrays([pa.array((a - 2).astype(np.int32)), pa.array((b - 1).astype(np.int32)), pa.array(found[1])],
                                             schema=arrow_schema(ID_COUNTS))

    return counts.mapInArrow(tidy(read), ID_COUNTS).groupBy("a", "b").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """What corpus counts say of words."""

    size: int  # ids; ``size`` itself stands for the end of a text
    first_n: np.ndarray  # how often an id (or the end) comes first
    pair_code: np.ndarray
    pair_n: np.ndarray
    pair_total: np.ndarray  # by id before
    single: np.ndarray  # share of an id as a further id; the last is the end of a word
    kept: np.ndarray  # by first id: counts of its words, each less DISCOUNT
    listed: pa.Array  # words; the next three are theirs
    list_n: np.ndarray
    list_first: np.ndarray
    list_rest: np.ndarray
    tokens: int
    distinct: int

    def chains(self, n_word: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of every word: its first id, the share of its own count among the words with this first id, the share
        left for words by their chain, and the natural log-probability of the chain without the steps whose pair
        counts are not here. Of these steps: the word, both ids (-1: the end), what is added to the count, and the total."""
        ends = np.cumsum(sizes)
        first = ids[ends - sizes]
        after = np.append(ids[1:], 0)
        after[ends - 1] = self.size  # the end of the word
        code = ids * (self.size + 1) + after
        at = np.minimum(np.searchsorted(self.pair_code, code), max(len(self.pair_code) - 1, 0))
        known = self.pair_code[at] == code if len(self.pair_code) else np.zeros(len(code), bool)
        n = np.where(known, self.pair_n[at], 0) if len(self.pair_code) else np.zeros(len(code))
        more, total = 20 * self.single[after], self.pair_total[ids] + 20
        chain = np.add.reduceat(np.where(known, np.log((n + more) / total), 0.0), ends - sizes)
        own = np.maximum(n_word - DISCOUNT, 0) / (self.first_n[first] + 1)
        left = 1 - self.kept[first] / (self.first_n[first] + 1)
        rare = np.flatnonzero(~known)
        word = np.repeat(np.arange(len(sizes)), sizes)[rare]
        return first, own, left, chain, word, ids[rare], np.where(after[rare] == self.size, -1, after[rare]), more[rare], total[rare]


@dataclass
class Firsts:
    """What the model says of first ids."""

    class_of: np.ndarray
    symbol_of: np.ndarray  # of ids, of the end, and of the start of a text at the last place
    log_in_class: np.ndarray
    attention: Attention


def word_scores(words: DataFrame, counted, file, pattern: str, pairs: DataFrame) -> DataFrame:
    """(word, n, first, rest) of the rows (word, n) of ``words``, each word once: its first id and the natural
    log-probability of the word given its first id. ``counted``: gives the counts in a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, counts, schema = subwords_of(file.value, pattern), counted(), arrow_schema(CHAINS)
        step = schema.field("rare").type
        for batch in slices(batches, 1 << 18, "word"):
            n = batch.column("n").to_numpy(zero_copy_only=False)
            ids, sizes = subwords(batch.column("word"))
            first, own, left, chain, word, *steps = counts.chains(n, ids, sizes)
            fields = [pa.array(x, f.type) for x, f in zip(steps, step.value_type, strict=True)]
            offsets = pa.array(np.searchsorted(word, np.arange(len(sizes) + 1)).astype(np.int32))
            rare = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(step.value_type)), type=step)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(first.astype(np.int32)), pa.array(own),
                                              pa.array(left), pa.array(chain), rare], schema=schema)

    found = materialize(words.select("word", "n").mapInArrow(tidy(read), CHAINS), "chains")
    steps = found.select("word", F.explode("rare").alias("step")).select("word", "step.*")
    counted = steps.join(pairs.where("a >= 0"), ["a", "b"], "left")
    log = F.log((F.coalesce(F.col("n"), F.lit(0)) + F.col("more")) / F.col("total"))
    sums = counted.groupBy("word").agg(F.sum(log).alias("joined"))
    chain = F.col("chain") + F.coalesce("joined", F.lit(0.0))
    return found.join(sums, "word", "left").select("word", "n", "first", F.log(F.col("own") + F.col("left") * F.exp(chain) + 1e-300).alias("rest"))


def cluster(vectors: np.ndarray, weights: np.ndarray, groups: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Weighted k-means."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), groups, replace=len(vectors) < groups, p=weights / weights.sum())]
    for _ in range(rounds):
        near = ((vectors * vectors).sum(1)[:, None] - 2 * vectors @ centres.T + (centres * centres).sum(1)).argmin(1)
        total = np.bincount(near, weights=weights, minlength=groups)
        for d in range(vectors.shape[1]):
            centres[:, d] = np.where(total > 0, np.bincount(near, weights=weights * vectors[:, d], minlength=groups) / np.maximum(total, 1e-9), centres[:, d])
    return near


def texts_read(plain: DataFrame, counted, file, pattern: str) -> DataFrame:
    """Every row of (doc, text, learned): the start of the text, the first id of every word and the end, what the listed words and
    the end add to the scores, and the other words with how often each comes. Each row has a number of its own, ``row``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut, counts, schema = subwords_of(file.value, pattern), counted(), arrow_schema(READ)
        pair = schema.field("others").type
        row, end, end_n = TaskContext.get().partitionId() << 40, cut.size, int(counts.first_n[cut.size])
        for batch in slices(batches, 4 << 20):
            flat, sizes = words_of(batch.column("text"))
            flat = flat.dictionary_encode()
            words, number = flat.dictionary, flat.indices.to_numpy()
            place = pc.fill_null(pc.index_in(words.cast(pa.binary()), counts.listed), -1).to_numpy()
            first, rest, n = np.zeros(len(words), np.int32), np.zeros(len(words)), np.zeros(len(words), np.int64)
            own, new = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
            first[own], rest[own], n[own] = counts.list_first[place[own]], counts.list_rest[place[own]], counts.list_n[place[own]]
            ids, lengths = cut(words.take(pa.array(new)))  # the rest of these words is joined
            first[new] = ids[np.cumsum(lengths) - lengths]
            ends = np.cumsum(sizes + 2).astype(np.int32)
            inner = np.ones(len(number) + 2 * len(sizes), bool)
            inner[ends - 1] = inner[ends - 2 - sizes] = False
            firsts = np.full(len(inner), end, np.int32)
            firsts[ends - 2 - sizes] = end + 1
            firsts[inner] = first[number]
            added = []
            for value, last in ((n > 0, end_n > 0), (np.log10(n + 1), np.log10(end_n + 1)), (rest, 0)):
                each = np.zeros(len(inner), float)
                each[inner], each[ends - 1] = value[number], last
                added.append(np.add.reduceat(each, ends - 2 - sizes))
            text = np.repeat(np.arange(len(sizes)), sizes)
            rare = np.flatnonzero(place[number] < 0)
            key, times = np.unique(text[rare] * np.int64(len(words) + 1) + number[rare], return_counts=True)
            of, word = np.divmod(key, len(words) + 1)
            others = pa.StructArray.from_arrays([words.take(pa.array(word)).cast(pa.binary()), pa.array(times, pa.int64())], fields=list(pair.value_type))
            offsets = pa.array(np.searchsorted(of, np.arange(len(sizes) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(row + np.arange(len(sizes))), batch.column("learned"),
                pa.ListArray.from_arrays(np.append(np.int32(0), ends), pa.array(firsts, pa.int32())),
                pa.array(added[0].astype(np.int64)), pa.array(added[1]), pa.array(added[2]),
                pa.ListArray.from_arrays(offsets, others, type=pair)], schema=schema)
            row += len(sizes)

    return plain.select("doc", "text", "learned").mapInArrow(tidy(read), READ)


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of whole texts laid end to end, about ``AT_ONCE`` together, and the number of each text's."""
    for batch in batches:
        sizes = np.diff(batch.column("firsts").offsets.to_numpy()).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.column("firsts").slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes[a:b]


def neighbours(firsts: DataFrame, place: np.ndarray) -> DataFrame:
    """(code, n): how often an id without class stands near one of a class, in all texts. ``place``: the class of an id, -1 for
    none, and -1 for the start; the code is id * classes + class."""
    groups = int(place.max()) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(place) * groups, np.int64)
        for ids, sizes in sequences(batches):
            of, ends = place[ids], np.cumsum(sizes)
            x = np.flatnonzero((of < 0) & (ids < len(place) - 1))  # the start has no neighbours
            low, high = np.repeat(ends - sizes, sizes)[x], np.repeat(ends, sizes)[x]
            for gap in (*GAPS, *(-g for g in GAPS)):
                y = x + gap
                hit = np.flatnonzero((y >= low) & (y < high))
                kind = of[y[hit]]
                np.add.at(found, ids[x[hit]][kind >= 0] * groups + kind[kind >= 0], 1)
        code = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"code": pa.array(code), "n": pa.array(found[code])})

    return firsts.select("firsts").mapInArrow(tidy(read), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def classes(first_n: np.ndarray, firsts: DataFrame, end: int, groups: int = CLASSES) -> np.ndarray:
    """A class for every first id: the most frequent ones and the end alone, the others by the ids around them."""
    order = np.argsort(-first_n, kind="stable")
    alone = [end, *[i for i in order[: groups * 2 // 3].tolist() if i != end and first_n[i] > 0]]
    out = np.full(len(first_n), -1)
    out[alone] = np.arange(len(alone))
    others = np.flatnonzero(out < 0)
    around = np.zeros(len(first_n) * len(alone))
    found = neighbours(firsts, np.append(out, -1)).toArrow()  # at most ids x classes, whatever the number of texts
    around[found.column("code").to_numpy()] = found.column("n").to_numpy()
    around = around.reshape(len(first_n), -1)
    vectors = np.sqrt(around[others] / np.maximum(around[others].sum(axis=1, keepdims=True), 1))
    out[others] = len(alone) + cluster(vectors, first_n[others] + 1e-3, groups - len(alone))
    return out


def reusing() -> None:
    """Memory of one step of the model is kept for the next, where the C library can be told so; ``tidy`` gives it back."""
    tell = getattr(ctypes.CDLL(None), "mallopt", None)
    if tell:
        tell(-1, 32 << 20)  # M_TRIM_THRESHOLD
        tell(-3, 8 << 20)  # M_MMAP_THRESHOLD


def taught(firsts: DataFrame, start: Attention, symbol_of: np.ndarray, class_of: np.ndarray) -> Attention:
    """The weights after every task has learned from all its texts."""
    sent = shipped(firsts.sparkSession, (Learner(start), symbol_of, class_of))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reusing()
        learner, symbols, kinds = sent()
        learner = learner.again()  # the worker may have run another task
        held, size = [], 0

        def learn() -> None:
            ids, sizes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            ends = np.cumsum(sizes)
            before, after = np.ones(len(ids), bool), np.ones(len(ids), bool)
            before[ends - 1] = after[ends - sizes] = False
            learner.learn(symbols[ids[before]], kinds[ids[after]], sizes - 1)

        for part in sequences(batches):
            held.append(part)
            size += len(part[0])
            if size >= AT_ONCE:
                learn()
                held, size = [], 0
        if size:
            learn()
        moved = learner.moved()
        for a in range(0, len(moved), CHUNK):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([a], pa.int32()), "sums": pa.array([moved[a : a + CHUNK]], pa.list_(pa.float64()))})

    rows = summed(firsts.select("firsts").mapInArrow(tidy(read), "chunk int, sums array<double>"), ["chunk"]).collect()  # one model
    return averaged(start, np.concatenate([r["sums"] for r in sorted(rows, key=lambda r: r["chunk"])])) if rows else start


def learn(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[Counts, Firsts, DataFrame, DataFrame, DataFrame]:
    """Both parts of the model, and the tables of all training word counts, of all counts of ids, and of all texts as read."""
    spark = docs.sparkSession
    file = shared_file(spark, vocabulary)
    plain = keyed_texts(docs, id_col, text_col).withColumn("learned", F.col("doc").isNotNull() & ~held_out("doc"))
    train = plain.where("learned")
    n_texts = train.count()
    counts = materialize(word_counts(train), "words")
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.where(F.octet_length("word") <= LISTED_BYTES).orderBy(F.desc("n"), "word").limit(LISTED).toArrow()
    listed = pa.array(top.column("word").to_pylist(), pa.binary())
    list_n = top.column("n").to_numpy().astype(np.int64)
    size = Subwords(file.value, pattern).size

    pairs = materialize(id_counts(counts, file, pattern), "pairs")
    follow = pairs.where("a >= 0")
    kept = follow.orderBy(F.desc("n"), "a", "b").limit(PAIRS).toArrow()
    firsts = pairs.where("a = -1").select("b", "n").toArrow()  # one row per id
    different = pairs.where("a = -2").select("b", "n").toArrow()  # one row per id
    before = follow.groupBy("a").agg(F.sum("n").alias("n")).toArrow()  # one row per id
    further = follow.groupBy("b").agg(F.sum("n").alias("n")).toArrow()  # one row per id
    first_n = np.zeros(size + 1, np.int64)
    first_n[firsts.column("b").to_numpy()] = firsts.column("n").to_numpy()
    first_n[size] = n_texts
    kept_n = first_n.astype(float)
    kept_n[size] = 0
    kept_n[different.column("b").to_numpy()] -= DISCOUNT * different.column("n").to_numpy()
    single = np.full(size + 1, 0.01)
    b = further.column("b").to_numpy().astype(np.int64)
    single[np.where(b < 0, size, b)] += further.column("n").to_numpy()
    single /= single.sum()
    a, b, n = (kept.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    code = a * (size + 1) + np.where(b < 0, size, b)
    order = np.argsort(code)
    pair_total = np.zeros(size + 1)
    pair_total[before.column("a").to_numpy()] = before.column("n").to_numpy()

    counted = Counts(size, first_n, code[order], n[order], pair_total, single, kept_n, listed, list_n,
                     np.zeros(len(listed), np.int32), np.zeros(len(listed)), int(n_words) + n_texts, int(distinct) + (n_texts > 0))
    if len(listed):
        rows = spark.createDataFrame(top)
        found = word_scores(rows, shipped(spark, counted), file, pattern, pairs).select("word", "first", "rest").toArrow()
        place = pc.index_in(pa.array(found.column("word").to_pylist(), pa.binary()), listed).to_numpy()
        counted.list_first[place], counted.list_rest[place] = found.column("first").to_numpy(), found.column("rest").to_numpy()
    read = materialize(texts_read(plain, shipped(spark, counted), file, pattern), "read")
    firsts = read.where("learned").select("doc", "firsts")
    picked = train.select("doc").orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE_TEXTS)
    pieces = F.transform(F.sequence(F.lit(0), F.size("firsts") - 2, F.lit(SAMPLE_WORDS)), lambda at: F.slice("firsts", at + 1, SAMPLE_WORDS + 1))
    taken = firsts.join(F.broadcast(picked.distinct()), "doc").select(F.explode(pieces).alias("firsts"))
    taken = taken.orderBy(F.xxhash64("firsts"), "firsts").limit(2 * SAMPLE_TEXTS).toArrow()
    sample = [np.array(x, np.int64) for x in taken.column("firsts").to_pylist()]  # led by what stands before

    class_of = classes(first_n, firsts, size)
    in_class = np.bincount(class_of, weights=first_n + 0.01, minlength=CLASSES)
    log_in_class = np.log((first_n + 0.01) / in_class[class_of])
    symbol_of = SYMBOLS + class_of
    common = [i for i in np.argsort(-first_n, kind="stable")[:SYMBOLS].tolist() if first_n[i] > 0]
    symbol_of[common] = np.arange(len(common))
    symbol_of = np.append(symbol_of, SYMBOLS + CLASSES)
    shares = (in_class + 1) / (in_class + 1).sum()
    attention = Attention.fresh(SYMBOLS + CLASSES + 1, CLASSES, shares)
    if sample:
        x = symbol_of[np.concatenate([s[:-1] for s in sample])]
        attention.train(x, class_of[np.concatenate([s[1:] for s in sample])], np.array([len(s) - 1 for s in sample]), STEPS)
        attention = taught(firsts, attention, symbol_of, class_of)

    return counted, Firsts(class_of, symbol_of, log_in_class, attention), counts, pairs, read


def scored(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    spark = docs.sparkSession
    counted, model, counts, pairs, texts = learn(docs, vocabulary, pattern, id_col, text_col)
    file, shared, told = shared_file(spark, vocabulary), shipped(spark, model), shipped(spark, counted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reusing()
        model, schema = shared(), arrow_schema(SCORED)
        for batch in batches:
            logs = []
            for ids, sizes in sequences([batch]):
                ends = np.cumsum(sizes)
                before, after = np.ones(len(ids), bool), np.ones(len(ids), bool)
                before[ends - 1] = after[ends - sizes] = False
                after = ids[after]
                of = model.log_in_class[after] + model.attention.score(model.symbol_of[ids[before]], model.class_of[after], sizes - 1)
                logs.append(np.add.reduceat(of, ends - sizes - np.arange(len(sizes))))
            if logs:
                score = (np.concatenate(logs) + batch.column("rest_listed").to_numpy()) / np.log(10)
                n_tokens = np.diff(batch.column("firsts").offsets.to_numpy()).astype(np.int64) - 1
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(n_tokens), batch.column("n_listed"),
                                                  batch.column("base_listed"), pa.array(score)], schema=schema)

    columns = "doc", "row", "firsts", "n_listed", "base_listed", "rest_listed"
    found = materialize(texts.select(*columns).mapInArrow(tidy(read), SCORED), "scored")
    other = texts.select("row", F.explode("others").alias("other")).select("row", "other.*")
    distinct = other.select("word").distinct().join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    rated = other.join(word_scores(distinct, told, file, pattern, pairs), "word")
    seen, times = F.when(F.col("n") > 0, F.col("times")), F.col("times")
    sums = rated.groupBy("row").agg(F.sum(seen).alias("n_other"), F.sum(times * F.log10(F.col("n") + 1)).alias("base_other"),
                                    F.sum(times * F.col("rest")).alias("rest_other"))
    per_token = float(np.log10(counted.tokens + counted.distinct + 1))
    return found.join(sums, "row", "left").select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", (F.col("n_listed") + F.coalesce("n_other", F.lit(0))).alias("n_known"),
        F.lit(counted.tokens).cast("long").alias("train_tokens"),
        (F.col("base_listed") + F.coalesce("base_other", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("score") + F.coalesce("rest_other", F.lit(0.0)) / float(np.log(10))).alias("score"))
