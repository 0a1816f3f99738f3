"""The registered queries of the corpus operators, one each, over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.llm.bpe import round_trip
from terrapanel.llm.chat import format_segments, read_segments
from terrapanel.llm.common import documents
from terrapanel.llm.fingerprints import with_edited
from terrapanel.llm.langid import identify
from terrapanel.llm.manifest import document_manifest
from terrapanel.llm.neardup import near_duplicates
from terrapanel.llm.packing import pack
from terrapanel.llm.pii import find
from terrapanel.llm.quality import quality
from terrapanel.llm.sharding import shard_documents
from terrapanel.llm.substrings import remove_repeats
from terrapanel.llm.trie import prefix_trie
from terrapanel.llm.vectors import near_vectors

SHARDS = 16


def tokenizer_path() -> str:
    """The vocabulary file: TOKENIZER_FILE, or the public package's byte-level one."""
    path = os.environ.get("TOKENIZER_FILE")
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), tokenizer_path())


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_segments(format_segments(rows.unionByName(extra)))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edited(documents(spark, sf_dir))


def op6_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), SHARDS)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), rebuild=True)


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(documents(spark, sf_dir))


LLM_QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_chat_format": op3_chat_format,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality_lines": op6_quality_lines,
    "op7_language": op7_language,
    "op8_private_data": op8_private_data,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_byte_shards": op10_byte_shards,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
