"""The dashboard reports in DuckDB SQL, written on their own; nothing of the code under test is imported.

Tables are the layer CTEs of ``duckdb_sql``: video_trends, category, channel, trending, opportunities.
"""

from __future__ import annotations

from trendspark.oracle.duckdb_sql import hr

_RISING = "trend_type = 'EMERGING' OR trend_type = 'RISING_CATEGORY' OR trend_type = 'CROSS_MARKET_EXPANSION'"


def _now(cte: str, columns: str, more: str = "true", tail: str = "", day: str = "snapshot_date") -> str:
    """Rows of the newest day of one table."""
    return f"SELECT {columns} FROM (SELECT *, max({day}) OVER () AS newest FROM {cte}) WHERE {day} = newest AND ({more}) {tail}"


def _mean(column: str, unit: int, places: int) -> str:
    return hr(f"CAST(sum(CAST(round({column} * {unit}) AS BIGINT)) AS BIGINT) / (count({column}) * {unit}.0::DOUBLE)", places)


def _total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


_MEDIAN = hr("quantile_disc(view_growth_rate, 0.5)", 4)
_WEIGHTED = ("CAST(sum(CAST(total_views AS DECIMAL(19,0)) * CAST(avg_engagement_rate AS DECIMAL(18,10))) AS DOUBLE)"
             " / nullif(CAST(sum(total_views) AS DOUBLE), 0)")
_OPPORTUNITY = "trend_score DESC, region, entity_id"

REPORTS: dict[str, str] = {
    "q1_1": _now("video_trends", "count(DISTINCT region) AS markets_monitored"),
    "q1_2": _now("video_trends", "count(DISTINCT video_id) AS videos_analyzed"),
    "q1_3": _now("opportunities", "count(*) AS emerging_trends", _RISING),
    "q1_4": _now("category", f"category_name, {_total('total_views')} AS total_views_all_markets",
                 tail="GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "q1_5": _now("video_trends", "title, channel_title, region, view_growth_rate, views", "view_growth_rate IS NOT NULL",
                 "ORDER BY view_growth_rate DESC, video_id, region LIMIT 1"),
    "q1_6": _now("category", f"category_name, {_WEIGHTED} AS weighted_avg_engagement_rate",
                 tail="GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "q1_7": (f"SELECT trending_date_parsed AS snapshot_date, {_total('total_videos')} AS total_videos, "
             f"{_total('total_views')} AS total_views FROM (SELECT *, max(trending_date_parsed) OVER () AS newest FROM trending) "
             "WHERE trending_date_parsed >= newest - 30 GROUP BY 1 ORDER BY 1"),
    "q1_8": _now("opportunities", "region, entity_name AS category_name, trend_score, velocity_score, market_expansion_score, evidence",
                 "scope = 'CATEGORY' AND trend_type <> 'DECLINING_CATEGORY'", f"ORDER BY {_OPPORTUNITY} LIMIT 10"),
    "q1_9": _now("opportunities", "region, entity_name AS video_title, trend_score, velocity_score, engagement_score, evidence",
                 "scope = 'VIDEO'", f"ORDER BY {_OPPORTUNITY} LIMIT 10"),
    "q1_10": _now("trending", "region, total_videos, total_views, avg_views_per_video, unique_channels, unique_categories",
                  tail="ORDER BY total_views DESC, region", day="trending_date_parsed"),
    "q2_1": _now("opportunities", "scope, region, entity_name, trend_type, trend_score, velocity_score, engagement_score, "
                 "persistence_score, market_expansion_score, rank, evidence", _RISING,
                 "ORDER BY trend_score DESC, scope, region, entity_id"),
    "q2_2": _now("video_trends", f"region, trend_stage, count(*) AS video_count, {_mean('view_growth_rate', 1_000_000, 4)} AS avg_growth_rate, "
                 f"{_MEDIAN} AS median_growth_rate", "view_growth_rate IS NOT NULL", "GROUP BY 1, 2 ORDER BY 1, 2"),
    "q2_3": _now("video_trends", "trend_stage, count(*) AS video_count, "
                 f"{hr('CAST(sum(trending_days_to_date) AS BIGINT)::DOUBLE / count(trending_days_to_date)', 1)} AS avg_trending_days, "
                 f"{_mean('persistence_score', 100, 1)} AS avg_persistence_score", tail="GROUP BY 1 ORDER BY 4 DESC, 1"),
    "q2_4": _now("category", "region, category_name, total_views, category_growth_pct, category_momentum, category_rank, rank_change",
                 "category_growth_pct > 0", "ORDER BY category_growth_pct DESC, region, category_id LIMIT 20"),
    "q2_5": _now("category", "region, category_name, total_views, category_growth_pct, category_momentum, category_rank, rank_change",
                 "category_growth_pct < 0", "ORDER BY category_growth_pct, region, category_id LIMIT 20"),
    "q2_6": _now("video_trends", "trend_stage, count(*) AS video_count", tail="GROUP BY 1 ORDER BY 2 DESC, 1"),
    "q2_7": _now("opportunities", "region, entity_name AS category_name, trend_type, trend_score, market_expansion_score, evidence",
                 "scope = 'CATEGORY'", f"ORDER BY {_OPPORTUNITY} LIMIT 15"),
    "q3_1": _now("trending", "region, total_videos, total_views, total_likes, total_comments, avg_views_per_video, "
                 "avg_engagement_rate, unique_channels, unique_categories", tail="ORDER BY total_views DESC, region",
                 day="trending_date_parsed"),
    "q3_2": _now("category", "region, category_name, total_views, view_share_pct, category_rank",
                 tail="ORDER BY region, category_rank, category_id"),
    "q3_3": _now("opportunities", "region, scope, entity_name, trend_type, trend_score, evidence", "region IS NOT NULL",
                 "QUALIFY row_number() OVER (PARTITION BY region ORDER BY trend_score DESC, scope, entity_id) < 6 "
                 "ORDER BY region, trend_score DESC, scope, entity_id"),
    "q3_4": _now("category", f"category_name, count(DISTINCT region) AS market_count, {_total('total_views')} AS total_views_all_markets, "
                 "list_sort(array_agg(DISTINCT region)) AS markets",
                 tail="GROUP BY 1 HAVING count(DISTINCT region) > 1 ORDER BY 2 DESC, 3 DESC, 1"),
    "q3_5": _now("category", "category_name, count(DISTINCT region) AS market_count, CASE WHEN count(DISTINCT region) < 2 THEN 'LOCAL' "
                 "WHEN count(DISTINCT region) < 7 THEN 'REGIONAL' ELSE 'GLOBAL' END AS reach_classification",
                 tail="GROUP BY 1 ORDER BY 2 DESC, 1"),
    "q3_6": _now("category", "category_name, region, total_views, category_growth_pct, category_momentum",
                 tail="ORDER BY category_name, category_growth_pct DESC NULLS LAST, region, category_id"),
    "q4_1": _now("channel", "region, channel_title, total_views_to_date, trending_video_count_to_date, rank_in_region",
                 tail="ORDER BY region, rank_in_region LIMIT 100"),
    "q4_2": _now("channel", "region, channel_title, trend_score, views_percentile, trending_frequency, markets_present",
                 tail="ORDER BY trend_score DESC, region, channel_id LIMIT 20"),
    "q4_3": _now("channel", "region, channel_title, avg_engagement_rate_to_date, total_views_to_date, trending_video_count_to_date",
                 tail="ORDER BY avg_engagement_rate_to_date DESC, region, channel_id LIMIT 20"),
    "q4_4": _now("video_trends", "region, title, channel_title, views, view_growth_rate, trend_stage, rank_in_region",
                 tail="ORDER BY views DESC, region, video_id LIMIT 50"),
    "q4_5": _now("video_trends", "trending_days_to_date, count(*) AS video_count", tail="GROUP BY 1 ORDER BY 1"),
    "q4_6": _now("channel", f"channel_title, max(markets_present) AS markets_present, {_total('total_views_to_date')} AS total_views_across_regions_shown",
                 tail="GROUP BY 1 HAVING max(markets_present) >= 2 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 30"),
    "q4_7": ("SELECT v.channel_title, c.category_name, count(*) AS trending_video_count, CAST(sum(v.views) AS BIGINT) AS total_views "
             "FROM video_trends v, category c WHERE v.category_id = c.category_id AND v.region = c.region "
             "AND v.snapshot_date = c.snapshot_date AND v.snapshot_date = (SELECT max(snapshot_date) FROM video_trends) "
             "GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 50"),
    "percentile_approx_growth": _now("video_trends", f"region, trend_stage, count(*) AS video_count, {_MEDIAN} AS median_growth_rate",
                                     "view_growth_rate IS NOT NULL", "GROUP BY 1, 2"),
}
