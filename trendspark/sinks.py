"""Parquet sinks: idempotent overwrite and the landing layout.

Gold is recomputed over the full history each run and replaces its whole table, so
a market or date that is gone leaves nothing behind; Silver and reference replace
exactly the partitions present in the frame. Which of the two is an option of the
write itself. Gold is partitioned by date, so the reports' newest-day predicate
prunes all other days. The ``rebalance`` hint lets AQE split a hot partition value
over several tasks and merge small ones, instead of one task per value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

GOLD_PARTITIONS = {
    "trending_analytics": ("trending_date_parsed",),
    "channel_analytics": ("snapshot_date",),
    "category_analytics": ("snapshot_date",),
    "video_trends": ("snapshot_date",),
    "trend_opportunities": ("snapshot_date",),
}


def write_table(df: DataFrame, path: str, partition_cols=(), whole: bool = False, metrics: list[Column] | None = None) -> dict:
    """Overwrite the partitions present in ``df``, or with ``whole`` the entire table; returns ``metrics``, aggregates
    over the rows as they are written. They are taken after the last shuffle, where a task that runs again counts once."""
    out = df.hint("rebalance", *partition_cols) if partition_cols else df
    seen = Observation() if metrics else None
    if seen is not None:
        out = out.observe(seen, *metrics)
    writer = (out.write.mode("overwrite").option("compression", "snappy")
              .option("partitionOverwriteMode", "static" if whole else "dynamic"))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return dict(seen.get) if seen is not None else {}


def write_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def write_landing(envelopes: DataFrame, base: str) -> None:
    """Append raw documents under ``region=/date=/hour=`` (never overwritten).

    ``envelopes`` carries ``items``, ``region``, ``date``, ``hour`` and the
    ingestion id/time; the lineage struct with the item count is added here.
    """
    enriched = envelopes.withColumn("_pipeline_metadata", F.struct(
        F.col("ingestion_id"), F.col("region").alias("region"),
        F.col("ingestion_timestamp"), F.lit("api").alias("source"),
        F.when(F.col("items").isNotNull(), F.size("items")).alias("item_count"),
    )).drop("ingestion_id", "ingestion_timestamp")
    enriched.write.mode("append").partitionBy("region", "date", "hour").json(base)
