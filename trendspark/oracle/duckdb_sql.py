"""Independent DuckDB SQL for the layer graph (the correctness oracle).

Each layer is a named CTE; ``with_layers(select, bridge)`` prepends exactly the
CTEs the final SELECT needs. Rounding goes through the decimal text of the
double (``_hr``), which is what Spark's HALF_UP ``round`` does, and means are
computed from integer units on both sides.
"""

from __future__ import annotations

import re

# Fixed values of the model, stated here on their own: nothing of the code under test is imported.
MARKETS = ("us", "gb", "in", "ca", "au", "de", "fr", "jp", "kr", "ru")
PART_TYPE_CATEGORY = {
    "ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6,
}
CATEGORY_NAMES = {
    1: "Film & Animation", 2: "Autos & Vehicles", 3: "Music",
    4: "Pets & Animals", 5: "Sports", 6: "Travel & Events",
}


class DEFAULT:
    emerging_max_days, emerging_growth_threshold = 3, 0.2
    fading_growth_threshold, established_min_days = -0.05, 7
    persistence_cap_days, total_markets = 7, 10
    video_weights, category_weights, channel_weights = (5, 3, 2), (8, 5, 7), (7, 3)
    top_videos, top_categories, top_channels = 20, 10, 10
    momentum_snapshots = 3


def hr(x: str, n: int) -> str:
    """HALF_UP rounding of a DOUBLE via its shortest decimal text."""
    return f"round(cast(cast(({x}) AS VARCHAR) AS DECIMAL(38,12)), {n})::DOUBLE"


def fixed(x: str, n: int) -> str:
    return f"CAST(CAST(({x}) AS DECIMAL(18,{n})) AS VARCHAR)"


def units(x: str) -> str:
    return f"CAST(round({x}) AS BIGINT)"


def _half_up(num: str, den: str) -> str:
    """HALF_UP (away from zero) in 128-bit integers."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))))"


def sc(num: str, den: str, places: int) -> str:
    """``num / den`` at ``places`` decimals, exact integer HALF_UP (as in Spark)."""
    return f"({_half_up(f'({num}) * {10 ** places}', den)}::DOUBLE / {10 ** places}.0::DOUBLE)"


def hdiv(num: str, den: str) -> str:
    return f"CAST({_half_up(num, den)} AS BIGINT)"


def weighted(parts: list[tuple[str, int]], den: int) -> str:
    n = " + ".join(f"{units(f'({c}) * 100')} * {w}" for c, w in parts)
    return f"(floor(({n} + {den // 2}) / {den}) / 100.0::DOUBLE)"


def exact(units_sql: str, divisor: int, scale: float) -> str:
    """HALF_UP ``units / divisor`` in integers, then scaled to a DOUBLE."""
    return (f"(CAST(sign({units_sql}) * ((2 * abs({units_sql}) + {divisor}) // ({2 * divisor})) AS BIGINT)"
            f" / {scale!r}::DOUBLE)")


def pct_score(value: str) -> str:
    r = f"rank() OVER (PARTITION BY region, snapshot_date ORDER BY {value} ASC NULLS FIRST)"
    n = "count(*) OVER (PARTITION BY region, snapshot_date)"
    return (f"CASE WHEN {n} > 1 THEN (({r} - 1) * 20000 + ({n} - 1)) // (2 * ({n} - 1)) / 100.0::DOUBLE "
            f"ELSE 0.0::DOUBLE END")


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


_MARKET_LIST = "[" + ", ".join(f"'{m}'" for m in MARKETS) + "]"
_CAT_NAMES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CATEGORY_NAMES.items())
_PART_TYPES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in PART_TYPE_CATEGORY.items())
_ISO = "%Y-%m-%dT%H:%M:%SZ"

RAW_ACTIVITY = f"""
raw AS (
  SELECT
    'u' || {s('user_id')} AS video_id,
    CASE WHEN user_id % 2 = 0 THEN strftime(_day, '%y.%d.%m') ELSE strftime(_day, '%Y-%m-%d') END AS trending_date,
    'Video ' || {s('user_id')} AS title,
    'Channel ' || {s('user_id % 25')} AS channel_title,
    CASE WHEN (user_id % 25) % 5 = 0 THEN NULL ELSE 'UC' || {s('user_id % 25')} END AS channel_id,
    CAST(user_id % 5 + 1 AS BIGINT) AS category_id,
    CAST(views AS BIGINT) AS views, CAST(likes AS BIGINT) AS likes,
    CAST(dislikes AS BIGINT) AS dislikes, CAST(comment_count AS BIGINT) AS comment_count,
    CASE WHEN user_id % 7 = 0 THEN NULL
         ELSE 'PT' || {s('user_id % 3')} || 'H' || {s('user_id % 60')} || 'M' || {s('user_id % 50')} || 'S' END AS duration,
    ' ' || _market || ' ' AS region,
    strftime(min(_first_ts) OVER (PARTITION BY user_id), '{_ISO}') AS publish_time
  FROM (
    SELECT user_id, upper({_MARKET_LIST}[event_id % {len(MARKETS)} + 1]) AS _market,
           CAST(ts AS DATE) AS _day,
           SUM(CASE WHEN event_type <> 'error' THEN floor(value * 100) END) AS views,
           count(*) FILTER (WHERE event_type = 'click') AS likes,
           count(*) FILTER (WHERE event_type = 'error') AS dislikes,
           count(*) FILTER (WHERE event_type = 'purchase') AS comment_count,
           min(ts) AS _first_ts
    FROM events GROUP BY 1, 2, 3
  )
)"""

RAW_ORDERS = f"""
raw AS (
  SELECT
    'p' || {s('p_partkey')} AS video_id,
    strftime(_month, '%Y-%m-%d') AS trending_date,
    p_name AS title, p_brand AS channel_title,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'BR-' || p_brand END AS channel_id,
    CAST(coalesce(CASE p_type {_PART_TYPES} END, 0) AS BIGINT) AS category_id,
    CAST(views AS BIGINT) AS views, CAST(likes AS BIGINT) AS likes,
    CAST(dislikes AS BIGINT) AS dislikes, CAST(comment_count AS BIGINT) AS comment_count,
    'PT' || {s('p_size')} || 'M' AS duration,
    r_name AS region,
    strftime(min(_first_ts) OVER (PARTITION BY p_partkey), '{_ISO}') AS publish_time
  FROM (
    SELECT l_partkey, r_name, date_trunc('month', o_orderdate)::DATE AS _month,
           SUM(floor(l_extendedprice)) AS views,
           SUM(CAST(trunc(l_quantity) AS BIGINT)) AS likes,
           count(*) FILTER (WHERE l_returnflag = 'R') AS dislikes,
           count(*) AS comment_count,
           min(o_orderdate) AS _first_ts
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3
  ) obs
  JOIN part ON l_partkey = p_partkey
)"""

_YYDDMM = r"^\d{2}\.\d{2}\.\d{2}$"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (f"{name} AS ({body})", deps)


_cte("silver0", f"""
  SELECT video_id, trending_date,
    CASE WHEN regexp_matches(trending_date, '{_YYDDMM}')
         THEN CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE)
         ELSE TRY_CAST(trending_date AS DATE) END AS trending_date_parsed,
    title, channel_title, channel_id, category_id, publish_time,
    coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
    coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count,
    duration, lower(trim(region)) AS region
  FROM raw WHERE video_id IS NOT NULL""", "raw")

_cte("silver1", f"""
  SELECT *,
    CASE WHEN views > 0 THEN {sc('likes * 100', 'views', 4)} ELSE 0.0::DOUBLE END AS like_ratio,
    CASE WHEN views > 0 THEN {sc('(likes + dislikes + comment_count) * 100', 'views', 4)} ELSE 0.0::DOUBLE END AS engagement_rate,
    CASE WHEN views > 0 THEN {sc('likes', 'views', 6)} ELSE 0.0::DOUBLE END AS like_rate,
    CASE WHEN views > 0 THEN {sc('comment_count', 'views', 6)} ELSE 0.0::DOUBLE END AS comment_rate,
    CASE WHEN duration IS NOT NULL THEN
      coalesce(TRY_CAST(regexp_extract(duration, '(\\d+)H', 1) AS INTEGER), 0) * 3600
      + coalesce(TRY_CAST(regexp_extract(duration, '(\\d+)M', 1) AS INTEGER), 0) * 60
      + coalesce(TRY_CAST(regexp_extract(duration, '(\\d+)S', 1) AS INTEGER), 0) END AS duration_seconds,
    {hdiv(f"date_diff('second', try_strptime(publish_time, '{_ISO}'), CAST(trending_date_parsed AS TIMESTAMP)) * 100", '3600')} AS _age_units
  FROM silver0""", "silver0")

_cte("silver", f"""
  SELECT * EXCLUDE (_age_units), _age_units / 100.0::DOUBLE AS video_age_hours,
    CASE WHEN _age_units IS NOT NULL
         THEN {sc('views * 100', 'greatest(_age_units, 100)', 2)} END AS views_per_hour
  FROM silver1""", "silver1")

REFERENCE = {
    "activity": f"""
  SELECT DISTINCT CAST(n_regionkey + 1 AS VARCHAR) AS id,
         coalesce(CASE n_regionkey + 1 {_CAT_NAMES} END, 'Category ' || {s('n_regionkey + 1')}) AS snippet_title,
         {_MARKET_LIST}[n_nationkey % {len(MARKETS)} + 1] AS region
  FROM nation""",
    "orders": f"""
  SELECT DISTINCT CAST(n_nationkey % 6 + 1 AS VARCHAR) AS id,
         coalesce(CASE n_nationkey % 6 + 1 {_CAT_NAMES} END, 'Category ' || {s('n_nationkey % 6 + 1')}) AS snippet_title,
         lower(trim(r_name)) AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
}
_cte("reference", "{REFERENCE}")

_cte("enriched", """
  SELECT s.*, coalesce(r._ref_name, 'Unknown Category ' || CAST(s.category_id AS VARCHAR)) AS category_name
  FROM silver s LEFT JOIN (
    SELECT TRY_CAST(id AS BIGINT) AS category_id, region, min(snippet_title) AS _ref_name
    FROM reference WHERE TRY_CAST(id AS BIGINT) IS NOT NULL GROUP BY 1, 2
  ) r ON s.category_id = r.category_id AND s.region = r.region""", "silver", "reference")

_cte("trending", f"""
  SELECT region, trending_date_parsed,
    count(video_id) AS total_videos,
    CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
    CAST(sum(dislikes) AS BIGINT) AS total_dislikes, CAST(sum(comment_count) AS BIGINT) AS total_comments,
    CAST(sum(views) AS BIGINT) / count(views) AS avg_views_per_video,
    CAST(sum({units('like_ratio * 10000')}) AS BIGINT) / (count(like_ratio) * 10000.0::DOUBLE) AS avg_like_ratio,
    CAST(sum({units('engagement_rate * 10000')}) AS BIGINT) / (count(engagement_rate) * 10000.0::DOUBLE) AS avg_engagement_rate,
    max(views) AS max_views,
    count(DISTINCT channel_title) AS unique_channels,
    count(DISTINCT category_id) AS unique_categories
  FROM enriched GROUP BY region, trending_date_parsed""", "enriched")

# ---- channel analytics -------------------------------------------------------
_cte("channel_daily", f"""
  SELECT coalesce(channel_id, channel_title) AS channel_key, region, trending_date_parsed,
    max(channel_title) AS channel_title,
    CAST(sum(views) AS BIGINT) AS daily_views, CAST(sum(likes) AS BIGINT) AS daily_likes,
    CAST(sum(comment_count) AS BIGINT) AS daily_comments,
    {hdiv(f"CAST(sum({units('engagement_rate * 10000')}) AS BIGINT) * 100", 'count(engagement_rate)')} AS engagement_units,
    max(views) AS daily_peak_views
  FROM enriched GROUP BY 1, 2, 3""", "enriched")

_cte("channel_new_videos", """
  SELECT channel_key, region, trending_date_parsed, count(*) AS new_distinct_videos
  FROM (SELECT coalesce(channel_id, channel_title) AS channel_key, region, video_id,
               min(trending_date_parsed) AS trending_date_parsed
        FROM enriched GROUP BY 1, 2, 3)
  GROUP BY 1, 2, 3""", "enriched")

_cte("channel_cum", """
  SELECT channel_key AS channel_id, channel_title, d.region, d.trending_date_parsed AS snapshot_date,
    CAST(sum(coalesce(n.new_distinct_videos, 0)) OVER w AS BIGINT) AS trending_video_count_to_date,
    CAST(sum(daily_views) OVER w AS BIGINT) AS total_views_to_date,
    CAST(sum(daily_likes) OVER w AS BIGINT) AS total_likes_to_date,
    CAST(sum(daily_comments) OVER w AS BIGINT) AS total_comments_to_date,
    CAST(sum(engagement_units) OVER w AS BIGINT) / (count(*) OVER w * 1000000.0::DOUBLE) AS avg_engagement_rate_to_date,
    max(daily_peak_views) OVER w AS peak_views_to_date,
    CAST(row_number() OVER w AS INTEGER) AS days_active_to_date,
    min(d.trending_date_parsed) OVER w AS first_trending_date
  FROM channel_daily d LEFT JOIN channel_new_videos n USING (channel_key, region, trending_date_parsed)
  WINDOW w AS (PARTITION BY channel_key, d.region ORDER BY d.trending_date_parsed
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "channel_daily", "channel_new_videos")

_cte("channel_freq", f"""
  SELECT *,
    CASE WHEN trending_video_count_to_date > 0
         THEN {sc('total_views_to_date', 'trending_video_count_to_date', 2)} ELSE 0.0::DOUBLE END AS avg_views_per_video_to_date,
    {sc('days_active_to_date', "(date_diff('day', first_trending_date, snapshot_date) + 1)", 4)} AS trending_frequency,
    CAST(row_number() OVER (PARTITION BY region, snapshot_date
                            ORDER BY total_views_to_date DESC NULLS LAST, channel_id ASC NULLS FIRST) AS INTEGER) AS rank_in_region
  FROM channel_cum""", "channel_cum")

_cte("channel", f"""
  SELECT *,
    {weighted([('views_percentile', DEFAULT.channel_weights[0]),
               ('round(trending_frequency * 10000) / 100.0::DOUBLE', DEFAULT.channel_weights[1])],
              sum(DEFAULT.channel_weights))} AS trend_score
  FROM (
    SELECT *,
      CAST(sum(CASE WHEN days_active_to_date = 1 THEN 1 ELSE 0 END) OVER (
        PARTITION BY channel_id ORDER BY snapshot_date
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS markets_present,
      {pct_score('total_views_to_date')} AS views_percentile
    FROM channel_freq)""", "channel_freq")

# ---- category analytics ------------------------------------------------------
_cte("category0", f"""
  SELECT category_id, region, trending_date_parsed AS snapshot_date,
    max(category_name) AS category_name,
    count(video_id) AS video_count,
    CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments,
    CAST(sum({units('engagement_rate * 10000')}) AS BIGINT) / (count(engagement_rate) * 10000.0::DOUBLE) AS avg_engagement_rate,
    count(DISTINCT channel_title) AS unique_channels
  FROM enriched GROUP BY 1, 2, 3""", "enriched")

_cte("category1", f"""
  SELECT *,
    CASE WHEN sum(total_views) OVER (PARTITION BY region, snapshot_date) > 0
         THEN {sc('total_views * 100', 'CAST(sum(total_views) OVER (PARTITION BY region, snapshot_date) AS BIGINT)', 2)} END AS view_share_pct,
    CAST(dense_rank() OVER (PARTITION BY region, snapshot_date ORDER BY total_views DESC NULLS LAST) AS INTEGER) AS category_rank
  FROM category0""", "category0")

_cte("category2", f"""
  SELECT *,
    CASE WHEN previous_total_views IS NULL OR previous_total_views = 0 THEN NULL
         ELSE {sc('(total_views - previous_total_views) * 100', 'previous_total_views', 2)} END AS category_growth_pct
  FROM (SELECT *,
          lag(total_views) OVER s AS previous_total_views,
          lag(category_rank) OVER s AS previous_rank
        FROM category1 WINDOW s AS (PARTITION BY category_id, region ORDER BY snapshot_date))""", "category1")

_cte("category", f"""
  SELECT *,
    CASE WHEN count(category_growth_pct) OVER m > 0
         THEN {hdiv(f"CAST(sum({units('category_growth_pct * 100')}) OVER m AS BIGINT)", 'count(category_growth_pct) OVER m')} / 100.0::DOUBLE END AS category_momentum,
    CASE WHEN previous_rank IS NOT NULL THEN previous_rank - category_rank END AS rank_change
  FROM category2
  WINDOW m AS (PARTITION BY category_id, region ORDER BY snapshot_date
               ROWS BETWEEN {DEFAULT.momentum_snapshots - 1} PRECEDING AND CURRENT ROW)""", "category2")

# ---- video trends ------------------------------------------------------------
_cte("vt0", """
  SELECT *, coalesce(like_rate, 0.0::DOUBLE) + coalesce(comment_rate, 0.0::DOUBLE) AS current_engagement_fraction,
    CAST(dense_rank() OVER (PARTITION BY region, trending_date_parsed ORDER BY views DESC NULLS LAST) AS INTEGER) AS rank_in_region
  FROM enriched""", "enriched")

_cte("vt1", """
  SELECT *,
    lag(views) OVER s AS previous_views, lag(likes) OVER s AS previous_likes,
    lag(comment_count) OVER s AS previous_comment_count,
    lag(current_engagement_fraction) OVER s AS previous_engagement_fraction,
    lag(rank_in_region) OVER s AS previous_rank,
    CAST(row_number() OVER s AS INTEGER) AS trending_days_to_date,
    min(trending_date_parsed) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_trending_date
  FROM vt0 WINDOW s AS (PARTITION BY video_id, region ORDER BY trending_date_parsed)""", "vt0")

_cte("vt2", f"""
  SELECT * EXCLUDE (trending_date_parsed), trending_date_parsed AS snapshot_date,
    previous_views IS NULL AS is_new_entrant,
    views - previous_views AS views_delta, likes - previous_likes AS likes_delta,
    comment_count - previous_comment_count AS comments_delta,
    CASE WHEN previous_views IS NULL OR previous_views = 0 THEN NULL
         ELSE {sc('views - previous_views', 'previous_views', 6)} END AS view_growth_rate,
    ({units('current_engagement_fraction * 1000000')} - {units('previous_engagement_fraction * 1000000')}) / 1000000.0::DOUBLE AS engagement_change,
    CASE WHEN previous_rank IS NOT NULL THEN previous_rank - rank_in_region END AS rank_change,
    {sc(f'least(trending_days_to_date, {DEFAULT.persistence_cap_days}) * 100', str(DEFAULT.persistence_cap_days), 2)} AS persistence_score
  FROM vt1""", "vt1")

_C = DEFAULT
_cte("video_trends", f"""
  SELECT *,
    CASE WHEN is_new_entrant THEN 'EMERGING'
         WHEN view_growth_rate < {_C.fading_growth_threshold} THEN 'FADING'
         WHEN trending_days_to_date <= {_C.emerging_max_days} AND view_growth_rate > {_C.emerging_growth_threshold} THEN 'EMERGING'
         WHEN trending_days_to_date > {_C.established_min_days} AND view_growth_rate >= {_C.fading_growth_threshold}
              AND view_growth_rate <= {_C.emerging_growth_threshold} THEN 'ESTABLISHED'
         WHEN view_growth_rate > 0 THEN 'SUSTAINING'
         ELSE 'ESTABLISHED' END AS trend_stage
  FROM vt2""", "vt2")

_cte("cross_market", f"""
  SELECT *,
    CASE WHEN previous_market_count IS NOT NULL THEN market_count - previous_market_count END AS market_count_delta,
    {sc('market_count * 100', str(_C.total_markets), 2)} AS market_expansion_score
  FROM (SELECT *, lag(market_count) OVER (PARTITION BY category_id ORDER BY snapshot_date) AS previous_market_count
        FROM (SELECT category_id, snapshot_date, max(category_name) AS category_name,
                     count(DISTINCT region) AS market_count,
                     CAST(sum(total_views) AS BIGINT) AS total_views_all_markets
              FROM category GROUP BY 1, 2))""", "category")

# ---- opportunities -----------------------------------------------------------

_cte("video_scores", f"""
  SELECT *,
    {weighted([('coalesce(velocity_score, 50.0::DOUBLE)', _C.video_weights[0]),
               ('coalesce(engagement_score, 0.0::DOUBLE)', _C.video_weights[1]),
               ('coalesce(persistence_score, 0.0::DOUBLE)', _C.video_weights[2])], 10)} AS trend_score
  FROM (SELECT *, {pct_score('view_growth_rate')} AS velocity_score,
               {pct_score('current_engagement_fraction')} AS engagement_score
        FROM video_trends)""", "video_trends")

_GU = "coalesce(CAST(round(view_growth_rate * 1000000) AS BIGINT), 0)"
_EU = ("(CAST(round(coalesce(like_rate, 0.0::DOUBLE) * 1000000) AS BIGINT)"
       " + CAST(round(coalesce(comment_rate, 0.0::DOUBLE) * 1000000) AS BIGINT))")

_cte("video_opps", f"""
  SELECT snapshot_date, region, 'VIDEO' AS scope, video_id AS entity_id, title AS entity_name,
    trend_stage AS trend_type, trend_score, velocity_score, engagement_score, persistence_score,
    0.0::DOUBLE AS market_expansion_score, rank,
    'Views ' || {fixed(exact(_GU, 1000, 10.0), 1)}
    || '% vs previous snapshot, trending ' || {s('trending_days_to_date')}
    || ' day(s), engagement ' || {fixed(exact(_EU, 100, 100.0), 2)} || '%.' AS evidence
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region, snapshot_date
                         ORDER BY trend_score DESC NULLS LAST, video_id ASC NULLS FIRST) AS INTEGER) AS rank
        FROM video_scores WHERE trend_stage IN ('EMERGING', 'SUSTAINING'))
  WHERE rank <= {_C.top_videos}""", "video_scores")

_cte("category_scores", f"""
  SELECT *,
    {weighted([('coalesce(velocity_score, 50.0::DOUBLE)', _C.category_weights[0]),
               ('coalesce(engagement_score, 0.0::DOUBLE)', _C.category_weights[1]),
               ('market_expansion_score', _C.category_weights[2])], 20)} AS trend_score,
    CASE WHEN coalesce(market_count_delta, 0) > 0 THEN 'CROSS_MARKET_EXPANSION'
         WHEN coalesce(category_growth_pct, 0.0::DOUBLE) > 0 THEN 'RISING_CATEGORY'
         ELSE 'DECLINING_CATEGORY' END AS trend_type
  FROM (SELECT c.*,
               coalesce(x.market_expansion_score, 0.0::DOUBLE) AS market_expansion_score,
               x.market_count, x.market_count_delta
        FROM (SELECT *, {pct_score('category_growth_pct')} AS velocity_score,
                     {pct_score('avg_engagement_rate')} AS engagement_score
              FROM category) c
        LEFT JOIN cross_market x
          ON c.category_id = x.category_id AND c.snapshot_date = x.snapshot_date)""",
     "category", "cross_market")

_cte("category_opps", f"""
  SELECT snapshot_date, region, 'CATEGORY' AS scope, CAST(category_id AS VARCHAR) AS entity_id,
    category_name AS entity_name, trend_type, trend_score, velocity_score, engagement_score,
    NULL::DOUBLE AS persistence_score, market_expansion_score, rank,
    'Growth ' || {fixed(exact('coalesce(CAST(round(category_growth_pct * 100) AS BIGINT), 0)', 10, 10.0), 1)}
    || '%, trending in ' || {s('coalesce(market_count, 1)')}
    || ' market(s), engagement ' || {fixed(hr('avg_engagement_rate * 1.0::DOUBLE', 2), 2)} || '%.' AS evidence
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region, snapshot_date
                         ORDER BY trend_score DESC NULLS LAST, category_id ASC NULLS FIRST) AS INTEGER) AS rank
        FROM category_scores)
  WHERE rank <= {_C.top_categories}""", "category_scores")

_cte("channel_opps", f"""
  SELECT snapshot_date, region, 'CHANNEL' AS scope, channel_id AS entity_id, channel_title AS entity_name,
    'HIGH_PERFORMING_CHANNEL' AS trend_type, trend_score, views_percentile AS velocity_score,
    NULL::DOUBLE AS engagement_score, NULL::DOUBLE AS persistence_score,
    0.0::DOUBLE AS market_expansion_score, rank,
    'Trending in ' || {s('coalesce(markets_present, 1)')} || ' market(s), '
    || {s('trending_video_count_to_date')} || ' video(s) trending to date, frequency '
    || {fixed(exact('CAST(round(trending_frequency * 10000) AS BIGINT)', 100, 1.0), 1)} || '%.' AS evidence
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region, snapshot_date
                         ORDER BY trend_score DESC NULLS LAST, channel_id ASC NULLS FIRST) AS INTEGER) AS rank
        FROM channel)
  WHERE rank <= {_C.top_channels}""", "channel")

_cte("opportunities", """
  SELECT * FROM video_opps UNION ALL SELECT * FROM category_opps UNION ALL SELECT * FROM channel_opps""",
     "video_opps", "category_opps", "channel_opps")

RAW = {"activity": RAW_ACTIVITY, "orders": RAW_ORDERS}


def _needed(select: str) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            if dep != "raw":
                visit(dep)
        order.append(name)

    for name in CTES:
        if re.search(rf"\b{name}\b", select):
            visit(name)
    return order


def with_layers(select: str, bridge: str = "activity") -> str:
    names = _needed(select)
    if not names:
        return select
    parts = [RAW[bridge].strip()] + [CTES[n][0].replace("{REFERENCE}", REFERENCE[bridge])
                                     for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + select
