"""The 30 dashboard queries over the five Gold tables, as Spark SQL.

Text placeholders ``{vt}`` (video_trends), ``{cat}`` (category_analytics),
``{ch}`` (channel_analytics), ``{ta}`` (trending_analytics) and ``{opp}``
(trend_opportunities) are bound to DataFrames through ``spark.sql(text,
**frames)``, so no global view name is needed. The "latest snapshot"
predicate compares with ``{day}``, one row with the newest snapshot day: over
layers it is the newest day of Silver, from which every Gold row derives (so the
report's own graph is planned once), over written tables that of the table's
partitions. Every ORDER BY ends in an entity tie-break, so rows and their order
are deterministic.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.publish import read_table
from trendspark.plans.layers import Layers

LATEST = "snapshot_date = (SELECT day FROM {day})"
#: Accuracy of the approximate median: exact while a group has fewer distinct growth rates than this, and an error of
#: at most 1/accuracy of the ranks beyond; the buffer is bounded by it.
MEDIAN_ACCURACY = 10_000
EMERGING_TYPES = "('EMERGING', 'RISING_CATEGORY', 'CROSS_MARKET_EXPANSION')"


REPORTS: dict[str, str] = {
    # ---- executive overview ----
    "q1_1": f"""SELECT COUNT(DISTINCT region) AS markets_monitored FROM {{vt}}
               WHERE {LATEST}""",
    "q1_2": f"""SELECT COUNT(DISTINCT video_id) AS videos_analyzed FROM {{vt}}
               WHERE {LATEST}""",
    "q1_3": f"""SELECT COUNT(*) AS emerging_trends FROM {{opp}}
               WHERE {LATEST} AND trend_type IN {EMERGING_TYPES}""",
    "q1_4": f"""SELECT category_name, SUM(total_views) AS total_views_all_markets FROM {{cat}}
               WHERE {LATEST} GROUP BY category_name
               ORDER BY total_views_all_markets DESC, category_name LIMIT 1""",
    "q1_5": f"""SELECT title, channel_title, region, view_growth_rate, views FROM {{vt}}
               WHERE {LATEST} AND view_growth_rate IS NOT NULL
               ORDER BY view_growth_rate DESC, video_id, region LIMIT 1""",
    "q1_6": f"""SELECT category_name,
                 CAST(SUM(CAST(total_views AS DECIMAL(19,0)) * CAST(avg_engagement_rate AS DECIMAL(18,10))) AS DOUBLE)
                   / CAST(NULLIF(SUM(total_views), 0) AS DOUBLE) AS weighted_avg_engagement_rate
               FROM {{cat}} WHERE {LATEST} GROUP BY category_name
               ORDER BY weighted_avg_engagement_rate DESC, category_name LIMIT 1""",
    "q1_7": """SELECT trending_date_parsed AS snapshot_date, SUM(total_videos) AS total_videos,
                 SUM(total_views) AS total_views FROM {ta}
               WHERE trending_date_parsed >= date_sub((SELECT day FROM {day}), 30)
               GROUP BY trending_date_parsed ORDER BY snapshot_date""",
    "q1_8": f"""SELECT region, entity_name AS category_name, trend_score, velocity_score,
                 market_expansion_score, evidence FROM {{opp}}
               WHERE {LATEST} AND scope = 'CATEGORY'
                 AND trend_type IN ('RISING_CATEGORY', 'CROSS_MARKET_EXPANSION')
               ORDER BY trend_score DESC, region, entity_id LIMIT 10""",
    "q1_9": f"""SELECT region, entity_name AS video_title, trend_score, velocity_score,
                 engagement_score, evidence FROM {{opp}}
               WHERE {LATEST} AND scope = 'VIDEO'
               ORDER BY trend_score DESC, region, entity_id LIMIT 10""",
    "q1_10": """SELECT region, total_videos, total_views, avg_views_per_video, unique_channels,
                 unique_categories FROM {ta}
               WHERE trending_date_parsed = (SELECT day FROM {day})
               ORDER BY total_views DESC, region""",
    # ---- emerging trends ----
    "q2_1": f"""SELECT scope, region, entity_name, trend_type, trend_score, velocity_score,
                 engagement_score, persistence_score, market_expansion_score, rank, evidence
               FROM {{opp}} WHERE {LATEST} AND trend_type IN {EMERGING_TYPES}
               ORDER BY trend_score DESC, scope, region, entity_id""",
    "q2_2": f"""SELECT region, trend_stage, COUNT(*) AS video_count,
                 ROUND(SUM(CAST(ROUND(view_growth_rate * 1000000) AS BIGINT))
                     / (COUNT(view_growth_rate) * 1000000.0D), 4) AS avg_growth_rate,
                 ROUND(percentile_approx(view_growth_rate, 0.5, {MEDIAN_ACCURACY}), 4) AS median_growth_rate
               FROM {{vt}} WHERE {LATEST} AND view_growth_rate IS NOT NULL
               GROUP BY region, trend_stage ORDER BY region, trend_stage""",
    "q2_3": f"""SELECT trend_stage, COUNT(*) AS video_count,
                 ROUND(SUM(trending_days_to_date) / 1.0D / COUNT(trending_days_to_date), 1)
                   AS avg_trending_days,
                 ROUND(SUM(CAST(ROUND(persistence_score * 100) AS BIGINT))
                     / (COUNT(persistence_score) * 100.0D), 1) AS avg_persistence_score
               FROM {{vt}} WHERE {LATEST} GROUP BY trend_stage
               ORDER BY avg_persistence_score DESC, trend_stage""",
    "q2_4": f"""SELECT region, category_name, total_views, category_growth_pct, category_momentum,
                 category_rank, rank_change FROM {{cat}}
               WHERE {LATEST} AND category_growth_pct > 0
               ORDER BY category_growth_pct DESC, region, category_id LIMIT 20""",
    "q2_5": f"""SELECT region, category_name, total_views, category_growth_pct, category_momentum,
                 category_rank, rank_change FROM {{cat}}
               WHERE {LATEST} AND category_growth_pct < 0
               ORDER BY category_growth_pct ASC, region, category_id LIMIT 20""",
    "q2_6": f"""SELECT trend_stage, COUNT(*) AS video_count FROM {{vt}}
               WHERE {LATEST} GROUP BY trend_stage ORDER BY video_count DESC, trend_stage""",
    "q2_7": f"""SELECT region, entity_name AS category_name, trend_type, trend_score,
                 market_expansion_score, evidence FROM {{opp}}
               WHERE {LATEST} AND scope = 'CATEGORY'
               ORDER BY trend_score DESC, region, entity_id LIMIT 15""",
    # ---- market intelligence ----
    "q3_1": """SELECT region, total_videos, total_views, total_likes, total_comments,
                 avg_views_per_video, avg_engagement_rate, unique_channels, unique_categories
               FROM {ta}
               WHERE trending_date_parsed = (SELECT day FROM {day})
               ORDER BY total_views DESC, region""",
    "q3_2": f"""SELECT region, category_name, total_views, view_share_pct, category_rank
               FROM {{cat}} WHERE {LATEST} ORDER BY region, category_rank, category_id""",
    "q3_3": f"""SELECT region, scope, entity_name, trend_type, trend_score, evidence FROM (
                 SELECT region, scope, entity_name, trend_type, trend_score, evidence,
                   ROW_NUMBER() OVER (PARTITION BY region
                                      ORDER BY trend_score DESC, scope, entity_id) AS rn
                 FROM {{opp}} WHERE {LATEST} AND region IS NOT NULL) ranked
               WHERE rn <= 5 ORDER BY region, rn""",
    "q3_4": f"""SELECT category_name, COUNT(DISTINCT region) AS market_count,
                 SUM(total_views) AS total_views_all_markets, sort_array(collect_set(region)) AS markets
               FROM {{cat}} WHERE {LATEST} GROUP BY category_name
               HAVING COUNT(DISTINCT region) > 1
               ORDER BY market_count DESC, total_views_all_markets DESC, category_name""",
    "q3_5": f"""SELECT category_name, COUNT(DISTINCT region) AS market_count,
                 CASE WHEN COUNT(DISTINCT region) >= 7 THEN 'GLOBAL'
                      WHEN COUNT(DISTINCT region) >= 2 THEN 'REGIONAL'
                      ELSE 'LOCAL' END AS reach_classification
               FROM {{cat}} WHERE {LATEST} GROUP BY category_name
               ORDER BY market_count DESC, category_name""",
    "q3_6": f"""SELECT category_name, region, total_views, category_growth_pct, category_momentum
               FROM {{cat}} WHERE {LATEST}
               ORDER BY category_name, category_growth_pct DESC, region, category_id""",
    # ---- channel intelligence ----
    "q4_1": f"""SELECT region, channel_title, total_views_to_date, trending_video_count_to_date,
                 rank_in_region FROM {{ch}} WHERE {LATEST}
               ORDER BY region, rank_in_region LIMIT 100""",
    "q4_2": f"""SELECT region, channel_title, trend_score, views_percentile, trending_frequency,
                 markets_present FROM {{ch}} WHERE {LATEST}
               ORDER BY trend_score DESC, region, channel_id LIMIT 20""",
    "q4_3": f"""SELECT region, channel_title, avg_engagement_rate_to_date, total_views_to_date,
                 trending_video_count_to_date FROM {{ch}} WHERE {LATEST}
               ORDER BY avg_engagement_rate_to_date DESC, region, channel_id LIMIT 20""",
    "q4_4": f"""SELECT region, title, channel_title, views, view_growth_rate, trend_stage,
                 rank_in_region FROM {{vt}} WHERE {LATEST}
               ORDER BY views DESC, region, video_id LIMIT 50""",
    "q4_5": f"""SELECT trending_days_to_date, COUNT(*) AS video_count FROM {{vt}}
               WHERE {LATEST} GROUP BY trending_days_to_date ORDER BY trending_days_to_date""",
    "q4_6": f"""SELECT channel_title, MAX(markets_present) AS markets_present,
                 SUM(total_views_to_date) AS total_views_across_regions_shown
               FROM {{ch}} WHERE {LATEST} GROUP BY channel_title
               HAVING MAX(markets_present) > 1
               ORDER BY markets_present DESC, total_views_across_regions_shown DESC, channel_title
               LIMIT 30""",
    "q4_7": f"""SELECT vt.channel_title, ca.category_name, COUNT(*) AS trending_video_count,
                 SUM(vt.views) AS total_views
               FROM {{vt}} vt JOIN {{cat}} ca
                 ON vt.category_id = ca.category_id AND vt.region = ca.region
                AND vt.snapshot_date = ca.snapshot_date
               WHERE vt.{LATEST}
               GROUP BY vt.channel_title, ca.category_name
               ORDER BY total_views DESC, vt.channel_title, ca.category_name LIMIT 50""",
}

# the dashboard's approximate median alone
APPROX_REPORTS = {
    "percentile_approx_growth": f"""SELECT region, trend_stage, COUNT(*) AS video_count,
                 ROUND(percentile_approx(view_growth_rate, 0.5, {MEDIAN_ACCURACY}), 4) AS median_growth_rate
               FROM {{vt}} WHERE {LATEST} AND view_growth_rate IS NOT NULL
               GROUP BY region, trend_stage""",
}

GOLD_TABLES = {"vt": "video_trends", "cat": "category_analytics", "ch": "channel_analytics",
               "ta": "trending_analytics", "opp": "trend_opportunities"}


def _names(text: str) -> list[str]:
    return [k for k in GOLD_TABLES if "{" + k + "}" in text]


def run_report(layers: Layers, text: str) -> DataFrame:
    """A report over the lazy layer graph; only the layers it names are planned."""
    frames = {"vt": lambda: layers.video_trends, "cat": lambda: layers.category, "ch": lambda: layers.channel,
              "ta": lambda: layers.trending, "opp": lambda: layers.opportunities}
    bound = {k: frames[k]() for k in _names(text)}
    return layers.spark.sql(text, **bound, day=layers.newest_day)


def run_report_on_gold(spark, gold_root: str, text: str) -> DataFrame:
    """A report over written Gold tables (the dashboard path): the newest day comes from the table's date partitions,
    and the subquery on it prunes the scan."""
    frames = {k: read_table(spark, os.path.join(gold_root, GOLD_TABLES[k])) for k in _names(text)}
    first = next(iter(frames.values()))
    column = "snapshot_date" if "snapshot_date" in first.columns else "trending_date_parsed"
    return spark.sql(text, **frames, day=first.agg(F.max(column).alias("day")))
