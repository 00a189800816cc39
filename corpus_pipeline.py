"""A training corpus from raw documents: quality rules, near-duplicates, repeated passages, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import near_duplicates, packing, quality, repeats, secret_scan
from txlake.llm.common import table
from txlake.llm.queries import tokenizer
from txlake.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated rules reject go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    return near_duplicates.survivors(docs, size=5, percent=80)


def counted_again(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; so do documents that lose all their words."""
    return counted_again(repeats.without_repeats(docs))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return counted_again(secret_scan.redacted(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of at most 2048 tokens."""
    return packing.packed(docs, tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", repeats_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Calibrated cutoffs, components over links, automata and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
