"""Landed documents that cannot be read: captured with their path instead of vanishing.

A fixed schema turns a truncated or foreign document into a row of nulls, which ``explode`` then drops without a word. Here
every landed document is one row with the text that could not be parsed, if any, and the rows are split in two: documents
that can be used, and dead letters with path, partition, reason and text. Good plus dead always equals landed.

Reasons: ``unparsable`` (not JSON, truncated, or of another type than the schema's), ``no items`` (JSON without an
``items`` array).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trendspark.sources.snapshots import ENVELOPE_SCHEMA

CORRUPT = "_corrupt_record"
#: Envelopes with the text of a document that the schema cannot hold.
CAPTURING_SCHEMA = StructType([*ENVELOPE_SCHEMA.fields, StructField(CORRUPT, StringType())])
DEAD = ("path", "region", "date", "hour", "reason", "text")


def read_landed(spark: SparkSession, base: str, markets=None, dates=None) -> DataFrame:
    """One row for each landed document: the envelope, ``_corrupt_record`` and ``path``; pruned by partition."""
    df = (spark.read.schema(CAPTURING_SCHEMA)
          .options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, basePath=base)
          .json(base).withColumn("path", F.col("_metadata.file_path")))
    if markets is not None:
        df = df.where(F.col("region").isin(list(markets)))
    if dates is not None:
        df = df.where(F.col("date").isin(list(dates)))
    return df


def split(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that can be used, dead letters) of ``read_landed`` or of a micro-batch of the same columns."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unparsable").when(F.col("items").isNull(), "no items")
    marked = landed.withColumn("reason", reason)
    good = marked.where("reason IS NULL").drop("reason", CORRUPT, "path")
    # the items are part of the projection, as a read of nothing but the damaged text is not allowed
    dead = marked.where("reason IS NOT NULL").select(
        "path", "region", "date", F.col("hour").cast("int").alias("hour"), "reason",
        F.when(F.coalesce(F.size("items"), F.lit(0)) >= -1, F.col(CORRUPT)).alias("text"))
    return good, dead


def write_dead_letters(dead: DataFrame, out: str, batch: str) -> None:
    """Write a batch's dead letters to its own folder, so a batch that is run again replaces its own and no other's."""
    dead.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch}")


def read_dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """All dead letters written so far."""
    return spark.read.option("basePath", out).parquet(out)


def account(landed: DataFrame) -> DataFrame:
    """One row: landed, good and dead documents, and dead ones by reason, in one pass."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unparsable").when(F.col("items").isNull(), "no items")
    return landed.select(reason.alias("reason"), "region").agg(
        F.count(F.lit(1)).alias("landed"), F.count_if(F.col("reason").isNull()).alias("good"),
        F.count("reason").alias("dead"), F.count_if(F.col("reason") == "unparsable").alias("unparsable"),
        F.count_if(F.col("reason") == "no items").alias("no_items"))
