"""Job bodies: landed snapshots -> Silver -> Gold -> trends, with quality gates.

Hand-offs between layers go through written tables (the shared output
folder), which also cuts the lineage: a lost executor recomputes from the
last written table, not from the raw files. Frames consumed several times
inside one job are persisted (MEMORY_AND_DISK; lost blocks are recomputed)
and released at the end.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.evolution import read_evolving, write_evolving
from trendspark.operators import gold, opportunities, quality, trends
from trendspark.plans.layers import Layers
from trendspark.publish import publish, read_table
from trendspark.session import prepare
from trendspark.sinks import GOLD_PARTITIONS, write_noop, write_table
from trendspark.sources import reference as reference_docs
from trendspark.sources import snapshots


def _path(root: str, name: str) -> str:
    return os.path.join(root, name)


def _stamped(df: DataFrame, aggregated_at: Column | None) -> DataFrame:
    """Gold lineage column; pass ``aggregated_at`` for reproducible output."""
    return df.withColumn("_aggregated_at",
                         aggregated_at if aggregated_at is not None else F.current_timestamp())


def run_silver(spark: SparkSession, landing: str, out_root: str, markets=None, dates=None,
               processed_at: Column | None = None, gate: bool = True, observed: bool = False) -> DataFrame:
    """Landed JSON -> clean_statistics (partitioned by market and date).

    The gate reads the whole written table. With ``observed`` it judges the rows of this run by counts taken while they
    are written, and reads only the table's keys again.
    """
    prepare(spark)
    env = snapshots.read_snapshot_envelopes(spark, landing, markets, dates)
    items = snapshots.flatten_items(env)
    if items.isEmpty():
        raise RuntimeError("no snapshot rows for the requested markets/dates")
    silver = snapshots.api_to_silver(items, "bronze_to_silver", processed_at)
    path = _path(out_root, "clean_statistics")
    metrics, stamp = quality.profile_metrics(silver.columns, "clean_statistics")
    seen = write_table(silver, path, ("region", "trending_date_parsed"), metrics=metrics if gate and observed else None)
    written = spark.read.parquet(path)
    if gate:
        profiles = {"clean_statistics": {"row": seen, "ts_column": stamp, "columns": set(silver.columns)}} if observed else None
        quality.assert_quality(quality.run_checks({"clean_statistics": written}, profiles=profiles))
    return written


def run_reference(spark: SparkSession, bronze: str, date: str, out_root: str,
                  ingested_at: Column | None = None) -> DataFrame:
    """Category reference documents of one date -> per-market Silver table.

    Raises when the date has no document or none is readable; only the
    markets present are overwritten (dynamic partition overwrite). New columns
    join the table's schema; a column whose type changed beyond widening is a
    ``SchemaConflict`` before anything is overwritten.
    """
    prepare(spark)
    reference_docs.reference_outcome(spark, bronze, date)
    flat = reference_docs.read_reference(spark, bronze, date, ingested_at)
    path = _path(out_root, "clean_reference_data")
    write_evolving(flat, path, ("region",))
    return read_evolving(spark, path)


def run_gold(spark: SparkSession, silver: DataFrame, reference: DataFrame, out_root: str,
             cfg: TrendConfig = DEFAULT, aggregated_at: Column | None = None) -> dict[str, DataFrame]:
    enriched = gold.add_category_name(silver, reference).persist(StorageLevel.MEMORY_AND_DISK)
    tables = {
        "trending_analytics": gold.build_trending_analytics(enriched),
        "channel_analytics": gold.build_channel_analytics(enriched, cfg),
        "category_analytics": gold.build_category_analytics(enriched, cfg),
    }
    out = {}
    for name, df in tables.items():
        publish(_stamped(df, aggregated_at), _path(out_root, name), GOLD_PARTITIONS[name])
        out[name] = read_table(spark, _path(out_root, name))
    enriched.unpersist()
    return out


def run_trends(spark: SparkSession, enriched: DataFrame, category: DataFrame,
               channel: DataFrame, out_root: str, cfg: TrendConfig = DEFAULT,
               gate: bool = True, aggregated_at: Column | None = None) -> dict[str, DataFrame]:
    vt = trends.compute_video_trends(enriched, cfg)
    publish(_stamped(vt, aggregated_at), _path(out_root, "video_trends"), GOLD_PARTITIONS["video_trends"])
    vt = read_table(spark, _path(out_root, "video_trends"))
    cross = trends.compute_cross_market(category, cfg)
    opp = opportunities.build_trend_opportunities(vt.drop("_aggregated_at"), category, cross,
                                                  channel, cfg)
    publish(_stamped(opp, aggregated_at), _path(out_root, "trend_opportunities"), GOLD_PARTITIONS["trend_opportunities"])
    out = {"video_trends": vt,
           "trend_opportunities": read_table(spark, _path(out_root, "trend_opportunities"))}
    if gate:
        quality.assert_quality(quality.run_checks(
            {**out, "category_analytics": category, "channel_analytics": channel}))
    return out


def run_all(spark: SparkSession, sf_dir: str, bridge: str = "orders", sink: str = "noop",
            out_root: str | None = None, cfg: TrendConfig = DEFAULT) -> dict[str, DataFrame]:
    """Every Gold table from a bridge source; ``sink='parquet'`` writes them."""
    layers = Layers(spark, sf_dir, bridge, cfg)
    if sink == "parquet":
        assert out_root, "out_root is required for the parquet sink"
        write_table(layers.silver, _path(out_root, "clean_statistics"), ("region",), whole=True)
        silver = spark.read.parquet(_path(out_root, "clean_statistics"))
        reference = layers.reference
        g = run_gold(spark, silver, reference, out_root, cfg)
        enriched = gold.add_category_name(silver, reference)
        t = run_trends(spark, enriched, g["category_analytics"].drop("_aggregated_at"),
                       g["channel_analytics"].drop("_aggregated_at"), out_root, cfg, gate=False)
        return {**g, **t}
    enriched = layers.enriched.persist(StorageLevel.MEMORY_AND_DISK)
    category = gold.build_category_analytics(enriched, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    channel = gold.build_channel_analytics(enriched, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    vt = trends.compute_video_trends(enriched, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    tables = {
        "trending_analytics": gold.build_trending_analytics(enriched),
        "category_analytics": category, "channel_analytics": channel, "video_trends": vt,
        "trend_opportunities": opportunities.build_trend_opportunities(
            vt, category, trends.compute_cross_market(category, cfg), channel, cfg),
    }
    for df in tables.values():
        write_noop(df)
    for df in (vt, channel, category, enriched):
        df.unpersist()
    return tables
