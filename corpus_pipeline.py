"""From raw documents to token ids: the stages a training corpus passes.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each stage's rows as Parquet
in the shared folder and reads them again as the next one's documents. All but the last stage return the
columns of documents; a stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gablework.llm import byte_suffixes, piece_model, quality, simhash, spaced_seeds
from gablework.llm.registry import table
from gablework.shared import scratch_path

SHINGLE_WORDS = 5
SIMILARITY = 0.8


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies the document with the smallest id stays."""
    return simhash.without_near_copies(docs, SHINGLE_WORDS, SIMILARITY)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: bytes that repeat a smaller document go; a document without text left goes too."""
    return byte_suffixes.cut_repeats(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go."""
    return spaced_seeds.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: (doc_id, n_tokens, ids) and whether the ids decode to the text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return piece_model.token_lists(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_leaks),
    ("byte_bpe", tokens),
]
ORACLE_SQL = None  # a learned classifier and fingerprints by XXH64 bits are tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
