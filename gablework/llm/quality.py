"""Quality classifier learned from trusted positives and unlabelled text (positive-unlabelled learning).

A logistic model over surface features minimises the non-negative unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: positives are documents trusted to be good, the
unlabelled ones are web text of either kind, and the class prior is estimated as the share of good ones
among the labelled training rows. When the second term falls below zero, the step goes against it
(the usual correction), so that a flexible model does not count the unlabelled positives as bad.

The fit sees bounded samples (``MAX_POSITIVES``, ``MAX_UNLABELLED``), taken in the order of a hash of the id;
every document is scored. Scoring is one narrow pass.

Defined results: null and empty texts have the features of an empty text and a score like any other.
Rows without id are scored, never learned from; they count as not held out. Other columns are not read.
Without labelled training rows of both kinds the prior is ``DEFAULT_PRIOR``; without positives or texts every score is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.batches import keyed_texts, slices, text_bytes, tidy
from gablework.llm.owners import arrow_schema
from gablework.shared import col

MAX_POSITIVES = 10_000
MAX_UNLABELLED = 20_000
DEFAULT_PRIOR = 0.5
THRESHOLD = 0.3
STEPS = 600
RATE = 0.05
DECAY = 1e-4
AT_ONCE = 1 << 20  # bytes of text looked at together
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])
SAMPLED = T.StructType([T.StructField("positive", T.BooleanType()), T.StructField("features", T.BinaryType())])


def features(texts: list[bytes | None]) -> np.ndarray:
    """Square roots of byte shares (bytes above 127 together) and a few shares of words, one row per text."""
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    counts = np.zeros((len(texts), 129), np.int64)
    for i, text in enumerate(texts):
        found = np.bincount(np.frombuffer(text or b"", np.uint8), minlength=256)
        counts[i, :128], counts[i, 128] = found[:128], found[128:].sum()
    shares = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    more = np.zeros((len(texts), 9))
    for i, text in enumerate(texts):
        words = (text or b"").split()
        n = len(words)
        if n:
            lines = text.split(b"\n")
            lengths = np.fromiter(map(len, words), np.int64, n)
            more[i] = (np.log1p(n), len(set(words)) / n, lengths.mean() / 10, lengths.std() / 10, np.log1p(lengths.max()),
                       len(set(lines)) / len(lines), np.log1p(len(lines)), np.log1p(n / len(lines)), sum(map(eq, words, words[1:])) / n)
    return np.concatenate([shares, more], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Non-negative positive-unlabelled risk with logistic loss, by Adam over the whole sample."""
    both = np.concatenate([positive, unlabelled])
    width = both.shape[1] if both.ndim == 2 else 0
    constant = Model(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(prior / (1 - prior))))
    if not len(positive) or not len(unlabelled):
        return constant
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    theta = np.append(np.zeros(width), constant.bias)
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(x: np.ndarray, sign: float) -> np.ndarray:
        """Of the mean of log(1 + exp(-sign * margin))."""
        g = -sign / (1 + np.exp(np.clip(sign * (x @ theta[:-1] + theta[-1]), -40, 40))) / len(x)
        return np.append(g @ x, g.sum())

    def loss(x: np.ndarray, sign: float) -> float:
        return float(np.logaddexp(0, -sign * (x @ theta[:-1] + theta[-1])).mean())

    for step in range(1, STEPS + 1):
        negative = loss(u, -1) - prior * loss(p, -1)
        against = gradient(u, -1) - prior * gradient(p, -1)
        g = prior * gradient(p, 1) + against if negative >= 0 else -against
        g[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) / (1 + step / 200)
    return Model(mean, scale, theta[:-1], float(theta[-1]))


def held_out(key: str, parts: int = 5, part: int = 0):
    return F.coalesce(F.crc32(col(key).cast("string")) % parts == part, F.lit(False))


def estimate_prior(labels: DataFrame, label_col: str = "quality") -> float:
    good, all_ = labels.agg(F.sum(col(label_col).cast("double")), F.count(col(label_col))).first()
    return DEFAULT_PRIOR if not all_ or not 0 < good < all_ else float(good) / all_


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Learns from the rows that are not held out. Both samples are bounded, and so is what the driver gets."""
    plain = keyed_texts(docs, id_col, text_col).where("doc IS NOT NULL")
    marks = labels.select(col(id_col).cast("long").alias("doc"), col(label_col).cast("int").alias("label"))
    marks = marks.where(F.col("doc").isNotNull() & F.col("label").isNotNull() & ~held_out("doc"))
    prior = estimate_prior(marks, "label")

    def first(ids: DataFrame, n: int, positive: bool) -> DataFrame:
        taken = ids.select("doc").orderBy(F.xxhash64("doc"), "doc").limit(n)
        return taken.select("doc", F.lit(positive).alias("positive"))

    picked = first(marks.where("label = 1"), max_positives, True).union(
        first(plain.where(~held_out("doc")), max_unlabelled, False))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, AT_ONCE):
            rows = [x.tobytes() for x in features(text_bytes(batch)).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(rows, pa.binary())], schema=arrow_schema(SAMPLED))

    sample = plain.join(F.broadcast(picked), "doc").mapInArrow(tidy(read), SAMPLED)
    # Repeated rows could make the sample larger than the bound.
    taken = sample.limit(2 * (max_positives + max_unlabelled)).toArrow()
    width = features([b""]).shape[1]
    x = np.frombuffer(b"".join(taken.column("features").to_pylist()), np.float32).reshape(taken.num_rows, width).astype(float)
    positive = np.array(taken.column("positive").to_pylist(), bool)
    return fit(x[positive], x[~positive], prior)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, in one narrow pass."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, AT_ONCE):
            score = model.score(features(text_bytes(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(score)], schema=arrow_schema(SCORED))

    return keyed_texts(docs, id_col, text_col).mapInArrow(tidy(read), SCORED)


def classified(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    found = scored(docs, learn(docs, labels))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept; one pass after learning."""
    model = learn(docs, labels)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, AT_ONCE, text_col):
            yield batch.filter(pa.array(model.score(features(text_bytes(batch, text_col))) >= threshold))

    return docs.mapInArrow(tidy(read), docs.schema)
