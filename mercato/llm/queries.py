"""Registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (bitsliced, byte_bpe, conversation_repair, hard_negatives, jaccard_join, language_id, mixing, quality_knn, quality_rules,
                         suffix_dedup, token_counts, token_files, word_bpe)
from mercato.llm.common import python_tasks, table, word_count
from mercato.llm.oracle import ORACLES


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality_knn.score(docs, labels)


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("host"), "text")
    return quality_rules.judge(docs)


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return bitsliced.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    return jaccard_join.join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return token_files.write_and_read(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return language_id.identify(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("key2"))
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return suffix_dedup.dedup(docs).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return word_bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(vectors, every=100)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    return conversation_repair.repair(table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "conv"))


QUERIES = {f.__name__: f for f in (
    op1_quality_neighbours, op2_line_frequency, op3_bit_sliced_top_k, op4_byte_bpe, op5_jaccard_join, op6_token_files,
    op7_token_counts, op8_language, op9_mix_sources, op10_suffix_dedup, op11_speculative_bpe, op12_hard_negatives,
    op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {name: ORACLES[name] for name in QUERIES if name in ORACLES}
