"""Metamorphic properties on the driver tables (sf0.01 activity bridge)."""

from pyspark.sql import functions as F

from trendspark.operators import gold, trends
from trendspark.plans.layers import Layers

SF = "/root/testdata/sf0.01"


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_results_do_not_depend_on_input_order(spark):
    layers = Layers(spark, SF)
    enriched = layers.enriched
    shuffled = enriched.repartition(7, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=5))
    cols = ["video_id", "region", "snapshot_date", "view_growth_rate", "rank_in_region",
            "trend_stage", "persistence_score", "engagement_change"]
    assert _rows(trends.compute_video_trends(enriched), cols) == \
        _rows(trends.compute_video_trends(shuffled), cols)
    ccols = ["channel_id", "region", "snapshot_date", "trend_score", "rank_in_region",
             "avg_engagement_rate_to_date", "markets_present"]
    assert _rows(gold.build_channel_analytics(enriched), ccols) == \
        _rows(gold.build_channel_analytics(shuffled), ccols)


def test_market_rollup_is_additive_over_market_splits(spark):
    enriched = Layers(spark, SF).enriched
    cols = ["region", "trending_date_parsed", "total_videos", "total_views", "avg_engagement_rate",
            "unique_channels"]
    whole = _rows(gold.build_trending_analytics(enriched), cols)
    west = gold.build_trending_analytics(enriched.where(F.col("region") < "fr"))
    east = gold.build_trending_analytics(enriched.where(F.col("region") >= "fr"))
    assert whole == _rows(west.unionByName(east), cols)


def test_video_series_is_local_to_each_market(spark):
    """Video trends of one market do not change when other markets are removed."""
    enriched = Layers(spark, SF).enriched
    cols = ["video_id", "snapshot_date", "previous_views", "view_growth_rate", "trending_days_to_date",
            "rank_in_region", "trend_stage"]
    all_markets = trends.compute_video_trends(enriched).where(F.col("region") == "us")
    only_us = trends.compute_video_trends(enriched.where(F.col("region") == "us"))
    assert _rows(all_markets, cols) == _rows(only_us, cols)


def test_channel_invariants(spark):
    ch = Layers(spark, SF).channel
    bad = ch.where(
        (F.col("trending_frequency") > 1) | (F.col("trending_frequency") <= 0)
        | (F.col("markets_present") < 1) | (F.col("markets_present") > 10)
        | (F.col("days_active_to_date") > F.datediff("snapshot_date", "first_trending_date") + 1)
        | (F.col("trend_score") < 0) | (F.col("trend_score") > 100)).count()
    assert bad == 0


def test_opportunity_ranks_are_dense_and_capped(spark):
    opp = Layers(spark, SF).opportunities
    per_group = opp.groupBy("scope", "region", "snapshot_date").agg(
        F.count("*").alias("n"), F.max("rank").alias("mx"), F.min("rank").alias("mn"))
    caps = {"VIDEO": 20, "CATEGORY": 10, "CHANNEL": 10}
    for r in per_group.collect():
        assert r.mn == 1 and r.mx == r.n <= caps[r.scope]


def test_bridge_rows_are_unique_per_grain(spark):
    """Layers skips the Silver de-dup shuffle for bridges; this pins why."""
    from trendspark.operators.quality import duplicate_rows
    for bridge in ("activity", "orders"):
        silver = Layers(spark, SF, bridge).silver
        assert duplicate_rows(silver, ["video_id", "region", "trending_date_parsed"]) \
            .first()["duplicate_row_count"] == 0
        assert silver.where(F.col("trending_date_parsed").isNull()).count() == 0
