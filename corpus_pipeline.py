"""The corpus pipeline: documents through five corpus operators, each stage over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendspark.llm import exactdedup, langid, minhash, packing, toxicity
from trendspark.llm.common import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return langid.known_language(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate texts."""
    return minhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its bin."""
    return packing.pack(docs)


STAGES = [("language", language), ("toxicity", not_toxic), ("exact_dedup", exact), ("minhash_dedup", near), ("packing", packed)]

#: Models learnt from the data and sampled similarities have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written for the next as a reliable checkpoint."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
