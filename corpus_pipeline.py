"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps;
its result is written as Parquet and read again as the next stage's input. All
stages but the last return the columns of ``documents``; the last adds
``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import decontaminate, simhash_pivots, soft_mixing, target_ratio, two_pass_shuffle
from keelson.llm.text import small_batches
from keelson.session import scratch_dir


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and the trusted-against-raw threshold."""
    small_batches(spark)
    return target_ratio.keep_good(docs, _labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of linked fingerprints."""
    small_batches(spark)
    return simhash_pivots.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than 5 % of the words are benchmark words."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by their fitted rates."""
    return soft_mixing.resample(docs, _labels(spark, sf_dir))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it."""
    return two_pass_shuffle.shuffle_into_shards(docs).select("doc.*", "shard", "slot")


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing),
          ("sharding", sharding)]

#: Hashed models and fitted rates have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := scratch_dir(spark, name.replace(" ", "-")))
        docs = spark.read.parquet(path)
    return docs
