"""From raw documents to token ids: quality rules, line and document deduplication, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the
shared checkpoint folder and hands the reread table to the next stage. All stages but the last keep the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm.common import settle
from clickscope.llm.line_dedup import line_dedup
from clickscope.llm.minhash_dedup import near_dedup
from clickscope.llm.mixing import mixed_documents
from clickscope.llm.quality_rules import quality_filter
from clickscope.llm.sentencepiece_codec import round_trip


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every class of equal or nearly equal lines keeps its first occurrence."""
    return line_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, in shard order; every run of blocks that a pass put in a shard is a row."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and same (the ids decode to the text)."""
    return round_trip(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mixing", mixing),
          ("sentencepiece", encoding)]

# Sampling hashes, sampled similarity and BPE have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
