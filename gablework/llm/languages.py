"""Language identification by mixtures: how much of a document is in which language.

Learning counts the byte n-grams of all training words per language (a grouped sum; n-grams are hashed
to ``BUCKETS`` places, so the model's size depends on the number of languages alone). A word's likelihood
in a language is that of its n-grams. Expectation-maximisation over a document's words gives the
languages' shares. The set of languages is grown from the one best by itself while the penalised
likelihood (``PENALTY`` nats and half the logarithm of the number of words per language) improves.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when there
is nothing to learn from. Ties go to the first language by name. Rows without id are predicted, but not
learned from, and count as not held out. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.batches import keyed_texts, mixed, shipped, slices, text_bytes
from gablework.llm.owners import arrow_schema
from gablework.shared import col

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 16
ROUNDS = 12
PENALTY = 12.0
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
PREDICTED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("shares", T.MapType(T.StringType(), T.DoubleType())),
])


def has_letter(text: str) -> bool:
    """Word characters such as superscripts and fractions are no letters."""
    return any(c.isalpha() for run in LETTERS.finditer(text) for c in run.group())


class Words:
    """Numbers for the different words of a block of texts."""

    def __init__(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram buckets of all words, one after the other, and to which word each belongs."""
        data = b"".join(b" " + w + b" " for w in self.known)
        size = np.fromiter(map(len, self.known), np.int64, len(self.known)) + 2
        word = np.repeat(np.arange(len(size)), size)
        byte = np.frombuffer(data, np.uint8).astype(np.uint64)
        buckets, owners, code = [], [], np.zeros(len(byte), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            keep = len(byte) - n + 1
            if keep <= 0:
                break
            code = code[:keep] * np.uint64(257) + byte[n - 1 :] + np.uint64(1)
            if n in GRAMS:
                inside = word[:keep] == word[n - 1 :]
                buckets.append((mixed(code[inside]) % np.uint64(BUCKETS)).astype(np.int64))
                owners.append(word[:keep][inside])
        return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Model:
    names: list[str]
    log_p: np.ndarray  # languages x buckets

    def word_likelihoods(self, words: Words) -> np.ndarray:
        """Log-likelihood of every word in every language, relative to its best language."""
        buckets, owner = words.grams()
        n = len(words.known)
        out = np.stack([np.bincount(owner, weights=p[buckets], minlength=n) for p in self.log_p], axis=1)
        return out - out.max(axis=1, keepdims=True)

    def shares(self, logs: np.ndarray) -> np.ndarray:
        """The languages' shares of one document; ``logs``: its words' log-likelihoods. Left out ones have 0."""
        single = logs.sum(axis=0)
        chosen = [int(single.argmax())]
        penalty = PENALTY + 0.5 * np.log(len(logs))
        theta, whole = mixture(logs)
        best, best_theta = single[chosen[0]], np.ones(1)
        while len(chosen) < len(self.names) and whole - best > penalty:
            rest = [k for k in np.argsort(-theta, kind="stable").tolist() if k not in chosen]
            tried = [mixture(logs[:, [*chosen, k]]) for k in rest]
            gain = [t[1] - best for t in tried]
            k = int(np.argmax(gain))
            if gain[k] <= penalty:
                break
            chosen, best, best_theta = [*chosen, rest[k]], tried[k][1], tried[k][0]
        out = np.zeros(len(self.names))
        out[chosen] = best_theta
        return out


def mixture(logs: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares and log-likelihood of a mixture, by expectation-maximisation."""
    p = np.exp(np.maximum(logs, -60))
    theta = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(ROUNDS):
        total = p @ theta
        theta = theta * ((1 / total) @ p) / len(p)
    return theta, float(np.log(p @ theta).sum())


def held_out(key: str, parts: int = 4, part: int = 2):
    return F.coalesce(F.crc32(col(key).cast("string")) % parts == part, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all training rows; the driver gets ``BUCKETS`` numbers per language."""
    plain = docs.select(col(id_col).cast("long").alias("doc"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
    train = plain.where(F.col("doc").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            words, used = Words(), defaultdict(list)
            for text, lang in zip(text_bytes(batch), batch.column("lang").to_pylist(), strict=True):
                used[lang].append(words.of(text))
            buckets, owner = words.grams()
            for lang, lists in used.items():
                times = np.bincount(np.concatenate(lists), minlength=len(words.known))
                if len(buckets):
                    found = np.bincount(buckets, weights=times[owner], minlength=BUCKETS).astype(np.int64)
                    counts[lang] = counts.get(lang, 0) + found
        for lang, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])], schema=arrow_schema(COUNTS))

    sums = train.select("text", "lang").mapInArrow(read, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sums.column("lang").to_pylist()
    names = sorted(set(langs))
    n = np.zeros((len(names), BUCKETS))
    if names:
        n[np.searchsorted(names, langs), sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return Model(names, np.log((n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)))


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, shares) for every row, in one narrow pass. ``score`` is the language's share."""
    shared = shipped(docs.sparkSession, model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, schema = shared(), arrow_schema(PREDICTED)
        for batch in slices(batches):
            words = Words()
            texts = [(t or b"") if model.names else b"" for t in text_bytes(batch)]
            numbers = [words.of(t) if has_letter(t.decode()) else None for t in texts]
            logs = model.word_likelihoods(words) if words.known else None
            langs, scores, shares = [], [], []
            for w in numbers:
                if w is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    shares.append([])
                else:
                    share = np.clip(model.shares(logs[w]), 0, 1)
                    k = int(share.argmax())
                    langs.append(model.names[k])
                    scores.append(float(share[k]))
                    shares.append([(n, float(s)) for n, s in zip(model.names, share, strict=True) if s > 0])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(langs), pa.array(scores), pa.array(shares, schema.field("shares").type)], schema=schema)

    return keyed_texts(docs, id_col, text_col).mapInArrow(read, PREDICTED)


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, shares) for every row."""
    return predicted(docs, learn(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "shares")
