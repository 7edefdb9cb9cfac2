"""The corpus pipeline: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all of ``docs``; all but
the last return the columns of ``docs``.  Documents travel as one struct where
an operator needs columns of its own, so no column of theirs can clash.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import byte_bpe, jaccard_join, mixing, quality_knn, suffix_dedup
from mercato.llm.common import in_buckets, materialize, python_tasks, table, word_count

#: Encoded runs that a worker of the last stage keeps: less than the encoder alone
#: would, as the stages before have grown the executors already.
ENCODER_ENTRIES = 200_000

ORACLE_SQL = None  # classifier, MinHash and tokenizer are beyond SQL; tests hold each stage against brute force


def packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay."""
    python_tasks(spark)
    rows = packed(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality_knn.scored(rows, labels).filter(F.col("score") >= quality_knn.THRESHOLD).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays.

    Rows are told apart by id and text: rows alike in both are one document, of
    which one row stays; rows that share an id but hold texts that nothing links
    all stay.  Documents without an id or without a word all stay.
    """
    python_tasks(spark)
    rows = packed(docs).withColumn("node", F.when(F.col("id").isNotNull(), F.xxhash64("id", "text")))
    classes = materialize(jaccard_join.join(rows.select(F.col("node").alias("id"), "text")), "classes")
    several = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND class_id IS NOT NULL").select(F.col("class_id").alias("of"))
    members = materialize(classes.join(several, F.col("class_id") == F.col("of")).select(F.col("doc_id").alias("member"), "class_id").distinct(), "class-members")
    wanted = members.select(F.col("member").alias("node"))
    first = (in_buckets(rows.select("id", "node"), wanted, ["node"]).join(members, F.col("node") == F.col("member"))
             .groupBy("class_id").agg(F.min(F.struct("id", "node")).alias("first")).select(F.col("first.node").alias("member"), F.lit(True).alias("stays")))
    judged = materialize(members.select("member").join(first, "member", "left"), "judged-members")
    wordless = word_count(F.col("text")) == 0
    alone = in_buckets(rows, wanted, ["node"], "left_anti").select("doc")
    checked = in_buckets(rows, wanted, ["node"]).join(judged, F.col("node") == F.col("member"), "left")
    untouched = checked.filter(F.col("member").isNull() | wordless).select("doc")
    kept = (checked.filter(F.col("stays") & ~wordless).groupBy("node")
            .agg(F.min_by("doc", F.xxhash64("text")).alias("doc")).select("doc"))
    return alone.union(untouched).union(kept).select("doc.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose what repeats; documents that had words and have none left go."""
    python_tasks(spark)
    rows = packed(docs).withColumn("had_words", word_count(F.col("text")) > 0)
    cut = suffix_dedup.dedup(rows)
    text = F.when(F.col("doc.text").isNotNull(), F.col("text"))
    changed = F.col("doc").withField("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    left = ~F.col("had_words") | (word_count(F.col("text")) > 0)
    return cut.filter(left).select(F.when(F.col("n_removed") > 0, changed).otherwise(F.col("doc")).alias("doc")).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Documents without a word are kept: they have no size to mix.
    """
    rows = packed(docs).select("doc", "id", "doc.source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("key2"))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise((F.col("taken") / F.col("size")).cast("int"))
    return mixing.mix(rows).select(F.explode(F.array_repeat("doc", times)).alias("doc")).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    python_tasks(spark)
    return byte_bpe.round_trip(packed(docs), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ENCODER_ENTRIES)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
