"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.llm import (
    byte_suffixes, language_model, languages, personal_data, piece_model, prefix_tree, projection_forest, quality, sharded_lloyd, simhash,
    spaced_seeds, token_files, word_windows,
)
from gablework.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from gablework.shared import scratch_path


@query("op1_lm_scoring")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return language_model.scored(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op2_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = byte_suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_simhash")
def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_languages")
def language_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identified(table(spark, sf_dir, "documents"))


@query("op5_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = piece_model.encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(table(spark, sf_dir, "embeddings"))


@query("op7_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = word_windows.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_decontamination", spaced_seeds.leaks_sql())
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_token_files")
def tokens_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    codec = token_files.tokenizer_codec(spark, public_tokenizers.path("word_bpe_49k.json"))
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, codec, end_id=2)
    return token_files.checked(spark, path)


@query("op10_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_prefix_trie", prefix_tree.nodes_sql())
def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree.prefix_nodes(table(spark, sf_dir, "conversations"))


@query("op12_personal_data")
def private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


@query("op13_centroids", sharded_lloyd.clusters_sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.clustered(table(spark, sf_dir, "embeddings"))
