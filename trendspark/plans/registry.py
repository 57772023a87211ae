"""Registered queries: Spark callable + independent DuckDB oracle SQL per name.

Operator queries run on the ``activity`` bridge (ten markets, daily series);
``*_orders`` variants run the same operators on the high-volume ``orders``
bridge. Non-deterministic lineage columns (``_processed_at``) are not
projected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.config import DEFAULT
from trendspark.oracle.duckdb_sql import sc, with_layers
from trendspark.oracle.reports_sql import REPORTS as REPORTS_SQL
from trendspark.operators import gold, quality, silver, sketches
from trendspark.operators.opportunities import video_scores
from trendspark.plans import reports, views
from trendspark.plans.layers import FIXED_AS_OF, Layers
from trendspark.sources.reference import flatten_reference
from trendspark.sources.snapshots import api_to_silver, parsed_records, region_from_path
from trendspark.sources.testdata import read_table
from trendspark.session import cut, prepare


@dataclass(frozen=True)
class Query:
    spark: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


def _cols(*names: str) -> str:
    return ", ".join(names)


def _layer_query(attr: str, columns: tuple[str, ...], cte: str, bridge: str = "activity",
                 where: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(Layers(spark, sf_dir, bridge), attr)
        if where is not None:
            df = df.where(where)
        return df.select(*columns)

    sql = f"SELECT {_cols(*columns)} FROM {cte}" + (f" WHERE {where}" if where else "")
    return Query(run, with_layers(sql, bridge))


SILVER_KEY = ("video_id", "region", "trending_date_parsed")
VT_KEY = ("video_id", "region", "snapshot_date")
CAT_KEY = ("category_id", "region", "snapshot_date")
CH_KEY = ("channel_id", "region", "snapshot_date")

CATEGORY_BASE = CAT_KEY + ("category_name", "video_count", "total_views", "total_likes",
                           "total_comments", "avg_engagement_rate", "unique_channels")
CHANNEL_CUM = CH_KEY + ("channel_title", "trending_video_count_to_date", "total_views_to_date",
                        "total_likes_to_date", "total_comments_to_date",
                        "avg_engagement_rate_to_date", "peak_views_to_date",
                        "days_active_to_date", "first_trending_date")
CHANNEL_ALL = CHANNEL_CUM + ("avg_views_per_video_to_date", "trending_frequency",
                             "rank_in_region", "markets_present", "views_percentile",
                             "trend_score")
VIDEO_ALL = VT_KEY + (
    "title", "channel_title", "channel_id", "category_id", "category_name", "views", "likes",
    "dislikes", "comment_count", "like_rate", "comment_rate", "previous_views",
    "previous_likes", "previous_comment_count", "is_new_entrant", "views_delta", "likes_delta",
    "comments_delta", "view_growth_rate", "current_engagement_fraction",
    "previous_engagement_fraction", "engagement_change", "rank_in_region", "previous_rank",
    "rank_change", "trending_days_to_date", "first_trending_date", "persistence_score",
    "trend_stage")
OPP_COLUMNS = ("snapshot_date", "region", "scope", "entity_id", "entity_name", "trend_type",
               "trend_score", "velocity_score", "engagement_score", "persistence_score",
               "market_expansion_score", "rank", "evidence")


def _dedup_latest() -> Query:
    """Latest event per (user, market, day): the Silver de-dup on real duplicates."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
        from trendspark.config import MARKETS
        markets = F.array(*[F.lit(m) for m in MARKETS])
        keyed = ev.select(
            "user_id",
            F.element_at(markets, (F.col("event_id") % len(MARKETS) + 1).cast("int")).alias("region"),
            F.to_date("ts").alias("day"), "ts", "event_id", "event_type", "value")
        return silver.deduplicate(keyed, key=("user_id", "region", "day"), order=("ts", "event_id"))

    from trendspark.config import MARKETS
    mlist = "[" + ", ".join(f"'{m}'" for m in MARKETS) + "]"
    sql = f"""SELECT user_id, region, day, ts, event_id, event_type, value FROM (
      SELECT user_id, {mlist}[event_id % {len(MARKETS)} + 1] AS region, CAST(ts AS DATE) AS day,
             ts, event_id, event_type, value,
             row_number() OVER (PARTITION BY user_id, {mlist}[event_id % {len(MARKETS)} + 1], CAST(ts AS DATE)
                                ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1"""
    return Query(run, sql)


def _json_props() -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = read_table(spark, sf_dir, "events", "event_id", "props")
        parsed = F.from_json("props", "k INT")
        return ev.select("event_id", parsed["k"].alias("k"))

    return Query(run, "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")


def _events_as_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API items made of ``events``: one per event, so a (user, market, day) that has several is landed repeatedly."""
    prepare(spark)
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.selectExpr(
        "concat('u', user_id) AS id",
        "named_struct('title', concat('Video ', event_id), 'channelTitle', concat('Channel ', user_id % 25),"
        " 'channelId', concat('UC', user_id % 25), 'categoryId', CAST(user_id % 5 + 1 AS STRING),"
        " 'publishedAt', '2020-01-01T00:00:00Z', 'tags', CAST(NULL AS STRING)) AS snippet",
        "named_struct('viewCount', IF(event_id % 9 = 0, 'junk', CAST(CAST(floor(value * 100) AS BIGINT) AS STRING)),"
        " 'likeCount', CAST(event_id % 50 AS STRING), 'commentCount', CAST(NULL AS STRING)) AS statistics",
        "named_struct('duration', concat('PT', user_id % 60, 'M')) AS contentDetails",
        "concat(' M', event_id % 3, ' ') AS region", "to_date(ts) AS date", "hour(ts) AS _hour",
        "CAST(ts AS STRING) AS _ingestion_timestamp", "CAST(event_id AS STRING) AS _ingestion_id")


def _api_silver() -> Query:
    cols = SILVER_KEY + ("title", "channel_id", "category_id", "views", "likes", "dislikes", "comment_count", "like_rate",
                         "duration_seconds", "_job_name")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stamp = F.lit(FIXED_AS_OF).cast("timestamp")
        stamped = F.date_format("_processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_text")
        return api_to_silver(_events_as_items(spark, sf_dir), "api", stamp).select(*cols, stamped)

    sql = f"""SELECT video_id, region, trending_date_parsed, title, channel_id, category_id, views, likes, dislikes, comment_count,
        CASE WHEN views > 0 THEN {sc('likes', 'views', 6)} ELSE 0.0::DOUBLE END AS like_rate, duration_seconds,
        'api' AS _job_name, '{FIXED_AS_OF}' AS processed_text
      FROM (SELECT 'u' || user_id AS video_id, 'm' || event_id % 3 AS region, CAST(ts AS DATE) AS trending_date_parsed,
          'Video ' || event_id AS title, 'UC' || user_id % 25 AS channel_id, CAST(user_id % 5 + 1 AS BIGINT) AS category_id,
          CASE WHEN event_id % 9 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS views,
          CAST(event_id % 50 AS BIGINT) AS likes, CAST(0 AS BIGINT) AS dislikes, CAST(0 AS BIGINT) AS comment_count,
          CAST(user_id % 60 * 60 AS INTEGER) AS duration_seconds,
          row_number() OVER (PARTITION BY user_id, event_id % 3, CAST(ts AS DATE)
                             ORDER BY hour(ts) DESC, ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn
        FROM events) WHERE rn = 1"""
    return Query(run, sql)


def _reference_flatten() -> Query:
    """Reference documents of 40 parts each, in the markets by turns, each part's item twice: the last copy of an id stays."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        part = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
        item = ("named_struct('id', CAST(p_partkey % 16 AS STRING), 'kind', CAST(copy AS STRING),"
                " 'snippet', named_struct('title', concat(p_name, '/', copy)))")
        docs = part.selectExpr("*", "p_partkey DIV 40 AS doc", "explode(array(1, 2)) AS copy").groupBy("doc").agg(
            F.expr(f"transform(array_sort(collect_list(struct(copy, p_partkey, {item} AS item))), x -> x.item)").alias("items"))
        raw = docs.selectExpr("items", "concat('s3://reference/region=m', doc % 10, '/date=2026-01-01/c', doc, '.json') AS _source_file")
        flat = flatten_reference(raw, F.lit(FIXED_AS_OF).cast("timestamp"))
        return flat.select("_source_file", "region", "id", "kind", "snippet_title", "_ingestion_timestamp")

    sql = """SELECT 's3://reference/region=m' || doc % 10 || '/date=2026-01-01/c' || doc || '.json' AS _source_file, 'm' || doc % 10 AS region,
        id, '2' AS kind, max_by(p_name, p_partkey) || '/2' AS snippet_title, '2026-01-01T00:00:00Z' AS _ingestion_timestamp
      FROM (SELECT p_partkey, p_name, p_partkey // 40 AS doc, CAST(p_partkey % 16 AS VARCHAR) AS id FROM part)
      GROUP BY doc, id"""
    return Query(run, sql)


def _market_heatmap() -> Query:
    """Views of the newest day's categories, a column a market."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        latest = reports.run_report(Layers(spark, sf_dir), f"SELECT region, category_name, total_views FROM {{cat}} WHERE {reports.LATEST}")
        return gold.market_heatmap(latest)

    markets = ", ".join(f"CAST(sum(total_views) FILTER (region = '{m}') AS BIGINT) AS \"{m}\"" for m in DEFAULT.markets)
    return Query(run, with_layers(f"""SELECT category_name, {markets}
      FROM (SELECT *, max(snapshot_date) OVER () AS newest FROM category) WHERE snapshot_date = newest GROUP BY 1"""))


def _growth_sketches() -> Query:
    """Medians of growth merged from daily sketches, held against the ranks of all rows."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trends = cut(Layers(spark, sf_dir).video_trends.select("region", "trend_stage", "snapshot_date", "view_growth_rate"))
        return sketches.bound_check(trends, sketches.merged_quantile(sketches.growth_sketches(trends)))

    return Query(run, with_layers("SELECT region, trend_stage, count(*) AS growth_count, true AS within_bound FROM video_trends "
                                  "WHERE view_growth_rate IS NOT NULL GROUP BY ALL"))


def _csv_recovery() -> Query:
    """Export text of five events each, whose first record leaves a quote open: the other records are found again."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
        line = ev.selectExpr("event_id", '''concat(lpad(CAST(event_id AS STRING), 11, 'v'), ',', date_format(ts, 'yy.dd.MM'),
            ',"Video ""', event_id, '"", by ', user_id, '",Channel ', user_id % 25, ',', user_id % 5 + 1, ',2020-01-01T00:00:00.000Z,"a|""b""",',
            CAST(floor(value * 100) AS BIGINT), ',', event_id % 50, ',0,', event_id % 7, ',http://x,FALSE,False,FALSE,"first',
            if(event_id % 5 = 0, '', concat(char(10), 'second, ', event_id % 3, '"'))) AS line''')
        texts = line.groupBy(F.expr("event_id DIV 5").alias("text_id")).agg(
            F.expr("array_join(transform(array_sort(collect_list(struct(event_id, line))), x -> x.line), char(10))").alias("text"))
        found = parsed_records(texts, F.col("text"))
        return found.select("text_id", F.col("_whole").alias("whole"), F.substring("_piece", 1, 11).alias("video_id"),
                            *[F.when(F.col("_whole"), F.col(f"_record.{c}")).alias(c) for c in ("trending_date", "title", "tags", "views", "likes", "description")])

    sql = """SELECT event_id // 5 AS text_id, event_id % 5 <> 0 AS whole, lpad(CAST(event_id AS VARCHAR), 11, 'v') AS video_id,
        CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%y.%d.%m') END AS trending_date,
        CASE WHEN event_id % 5 <> 0 THEN 'Video "' || event_id || '", by ' || user_id END AS title,
        CASE WHEN event_id % 5 <> 0 THEN 'a|"b"' END AS tags,
        CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS views,
        CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 50 AS VARCHAR) END AS likes,
        CASE WHEN event_id % 5 <> 0 THEN 'first' || chr(10) || 'second, ' || event_id % 3 END AS description
      FROM events"""
    return Query(run, sql)


def _path_region() -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = read_table(spark, sf_dir, "pages", "page_id", "url")
        path = F.expr("CASE page_id % 3 WHEN 0 THEN concat('s3://b/region=m', page_id % 7, '/date=2026-01-01/x') "
                      "WHEN 1 THEN concat('region=', substr(url, 1, 4), '/y') ELSE url END")
        return pages.select("page_id", region_from_path(path).alias("region"))

    sql = """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'm' || page_id % 7 WHEN 1 THEN substr(url, 1, 4) ELSE 'unknown' END AS region
      FROM pages"""
    return Query(run, sql)


def _video_scores() -> Query:
    cols = VT_KEY + ("velocity_score", "engagement_score", "trend_score")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return video_scores(Layers(spark, sf_dir).video_trends).select(*cols)

    return Query(run, with_layers(f"SELECT {_cols(*cols)} FROM video_scores"))


def _channel_stage(fn, columns, cte) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers(spark, sf_dir).enriched).select(*columns)

    return Query(run, with_layers(f"SELECT {_cols(*columns)} FROM {cte}"))


def _report(name: str, text: str, bridge: str = "activity") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.run_report(Layers(spark, sf_dir, bridge), text)

    return Query(run, with_layers(REPORTS_SQL[name], bridge))


def _quality(check: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.CHECK_FRAMES[check](Layers(spark, sf_dir))

    return Query(run, with_layers(quality.ORACLE[check]))


def build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # ---- Silver operators
    q["dedup_latest"] = _dedup_latest()
    q["canonical_rates"] = _layer_query("silver", SILVER_KEY + (
        "views", "likes", "dislikes", "comment_count", "like_ratio", "engagement_rate",
        "like_rate", "comment_rate"), "silver")
    q["duration_seconds"] = _layer_query("silver", SILVER_KEY + ("duration", "duration_seconds"), "silver")
    q["velocity_context"] = _layer_query("silver", SILVER_KEY + (
        "publish_time", "video_age_hours", "views_per_hour"), "silver")
    q["clean_dates"] = _layer_query("silver", ("video_id", "region", "trending_date",
                                               "trending_date_parsed"), "silver")
    q["json_props"] = _json_props()
    q["api_silver"] = _api_silver()
    q["reference_flatten"] = _reference_flatten()
    q["region_from_path"] = _path_region()
    q["csv_recovery"] = _csv_recovery()
    q["growth_sketches"] = _growth_sketches()
    # ---- Gold
    q["category_lookup"] = _layer_query("enriched", SILVER_KEY + ("category_id", "category_name"),
                                        "enriched")
    q["trending_rollup"] = _layer_query("trending", (
        "region", "trending_date_parsed", "total_videos", "total_views", "total_likes",
        "total_dislikes", "total_comments", "avg_views_per_video", "avg_like_ratio",
        "avg_engagement_rate", "max_views", "unique_channels", "unique_categories"), "trending")
    q["category_rollup"] = _layer_query("category", CATEGORY_BASE, "category")
    q["category_share"] = _layer_query("category", CAT_KEY + ("total_views", "view_share_pct"), "category")
    q["category_growth"] = _layer_query("category", CAT_KEY + (
        "total_views", "previous_total_views", "category_growth_pct"), "category")
    q["category_momentum"] = _layer_query("category", CAT_KEY + (
        "category_growth_pct", "category_momentum"), "category")
    q["category_rank_change"] = _layer_query("category", CAT_KEY + (
        "category_rank", "previous_rank", "rank_change"), "category")
    q["channel_daily"] = _channel_stage(gold.channel_daily, (
        "channel_key", "region", "trending_date_parsed", "channel_title", "daily_views",
        "daily_likes", "daily_comments", "engagement_units", "daily_peak_views"), "channel_daily")
    q["channel_new_videos"] = _channel_stage(gold.channel_new_videos, (
        "channel_key", "region", "trending_date_parsed", "new_distinct_videos"), "channel_new_videos")
    q["channel_cumulative"] = _layer_query("channel", CHANNEL_CUM, "channel")
    q["channel_frequency"] = _layer_query("channel", CH_KEY + (
        "avg_views_per_video_to_date", "trending_frequency", "rank_in_region"), "channel")
    q["channel_markets_present"] = _layer_query("channel", CH_KEY + ("markets_present",), "channel")
    q["channel_trend_score"] = _layer_query("channel", CH_KEY + (
        "views_percentile", "trend_score"), "channel")
    # ---- trends
    q["video_lag_growth"] = _layer_query("video_trends", VT_KEY + (
        "views", "previous_views", "previous_likes", "previous_comment_count", "is_new_entrant",
        "views_delta", "likes_delta", "comments_delta", "view_growth_rate"), "video_trends")
    q["video_engagement_change"] = _layer_query("video_trends", VT_KEY + (
        "current_engagement_fraction", "previous_engagement_fraction", "engagement_change"),
        "video_trends")
    q["video_rank_change"] = _layer_query("video_trends", VT_KEY + (
        "views", "rank_in_region", "previous_rank", "rank_change"), "video_trends")
    q["video_persistence"] = _layer_query("video_trends", VT_KEY + (
        "trending_days_to_date", "first_trending_date", "persistence_score"), "video_trends")
    q["video_trend_stage"] = _layer_query("video_trends", VT_KEY + (
        "view_growth_rate", "trending_days_to_date", "trend_stage"), "video_trends")
    q["video_trends"] = _layer_query("video_trends", VIDEO_ALL, "video_trends")
    q["cross_market"] = _layer_query("cross_market", (
        "category_id", "snapshot_date", "category_name", "market_count", "total_views_all_markets",
        "previous_market_count", "market_count_delta", "market_expansion_score"), "cross_market")
    q["percentile_score"] = _video_scores()
    q["video_opportunities"] = _layer_query("opportunities", OPP_COLUMNS, "opportunities",
                                            where="scope = 'VIDEO'")
    q["category_opportunities"] = _layer_query("opportunities", OPP_COLUMNS, "opportunities",
                                               where="scope = 'CATEGORY'")
    q["channel_opportunities"] = _layer_query("opportunities", OPP_COLUMNS, "opportunities",
                                              where="scope = 'CHANNEL'")
    q["trend_opportunities"] = _layer_query("opportunities", OPP_COLUMNS, "opportunities")
    # ---- same operators on the high-volume orders bridge
    q["category_rollup_orders"] = _layer_query("category", CATEGORY_BASE + (
        "view_share_pct", "category_growth_pct", "category_momentum", "category_rank",
        "rank_change"), "category", bridge="orders")
    q["channel_analytics_orders"] = _layer_query("channel", CHANNEL_ALL, "channel", bridge="orders")
    q["video_trends_orders"] = _layer_query("video_trends", VIDEO_ALL, "video_trends", bridge="orders")
    q["trend_opportunities_orders"] = _layer_query("opportunities", OPP_COLUMNS, "opportunities",
                                                   bridge="orders")
    # ---- data quality
    for check in quality.CHECK_FRAMES:
        q[check] = _quality(check)
    # ---- reports and published views
    for name, text in reports.REPORTS.items():
        q[name] = _report(name, text)
    for name, text in reports.APPROX_REPORTS.items():
        q[name] = _report(name, text)
    for name, (attr, cols, cte) in views.VIEWS.items():
        q[name] = _layer_query(attr, cols, cte)
    q["v_market_heatmap"] = _market_heatmap()
    return q
