"""Published BI views: curated column subsets of the five Gold tables.

``register_views`` creates them as temp views over the Gold DataFrames (a
live view is the same as a direct query); ``VIEWS`` also drives the
registered queries: name -> (Layers attribute, columns, oracle CTE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

VIEWS: dict[str, tuple[str, tuple[str, ...], str]] = {
    "v_video_trends": ("video_trends", (
        "video_id", "region", "snapshot_date", "title", "channel_title", "channel_id",
        "category_id", "views", "likes", "comment_count", "previous_views", "views_delta",
        "view_growth_rate", "is_new_entrant", "rank_in_region", "rank_change",
        "trending_days_to_date", "persistence_score", "trend_stage"), "video_trends"),
    "v_category": ("category", (
        "category_id", "category_name", "region", "snapshot_date", "video_count", "total_views",
        "avg_engagement_rate", "unique_channels", "view_share_pct", "category_growth_pct",
        "category_momentum", "category_rank", "rank_change"), "category"),
    "v_channel": ("channel", (
        "channel_id", "channel_title", "region", "snapshot_date", "trending_video_count_to_date",
        "total_views_to_date", "avg_views_per_video_to_date", "avg_engagement_rate_to_date",
        "peak_views_to_date", "days_active_to_date", "trending_frequency", "rank_in_region",
        "markets_present", "trend_score"), "channel"),
    "v_opportunities": ("opportunities", (
        "snapshot_date", "region", "scope", "entity_id", "entity_name", "trend_type",
        "trend_score", "velocity_score", "engagement_score", "persistence_score",
        "market_expansion_score", "rank", "evidence"), "opportunities"),
    "v_overview": ("trending", (
        "region", "trending_date_parsed", "total_videos", "total_views", "avg_views_per_video",
        "avg_engagement_rate", "unique_channels", "unique_categories"), "trending"),
}


def register_views(layers) -> dict[str, DataFrame]:
    out = {}
    for name, (attr, cols, _) in VIEWS.items():
        df = getattr(layers, attr).select(*cols)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
