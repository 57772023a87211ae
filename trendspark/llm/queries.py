"""The registered queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trendspark.llm import align, codec, embdedup, exactdedup, langid, licenses, merkle, minhash, packing, quality, tokencount, toxicity, urlfilter
from trendspark.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from the rows that are not held out."""
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every whole text."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of exact ids and of the text decoded from them."""
    return codec.codec_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every URL."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every whole text, learnt from the rows that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its bin."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate vectors of a label."""
    return embdedup.vector_groups(table(spark, sf_dir, "embeddings"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every whole text names."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exactdedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every whole text."""
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.alignment(table(spark, sf_dir, "documents"), *paths)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the verdict of the n-gram likelihood ratio for every whole text."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verdict in the manifest of the whole table."""
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_token_counts, op3_url_filter, op4_toxicity, op5_best_fit_packing, op6_bpe_codec,
        op7_embedding_dedup, op8_minhash_dedup, op9_license_scan, op10_exact_dedup, op11_token_alignment, op12_quality_rules, op13_merkle_manifest,
    )
}

ORACLE_SQL: dict[str, str] = {"op7_embedding_dedup": embdedup.ORACLE_SQL, "op10_exact_dedup": exactdedup.ORACLE_SQL, "op13_merkle_manifest": merkle.ORACLE_SQL}
