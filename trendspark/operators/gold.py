"""Gold analytics: category lookup, market rollup, channel and category history.

Semantics follow the snapshot model: every comparison is against the same
entity's own previous snapshot in the same market; cumulative columns are
"as of this snapshot date". Fixes over the modelled pipeline: channels and
categories are grouped by their key only (a renamed channel or a fallback
category name cannot split one key into two rows), and every ranking has a
key tie-break so results do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.functions.columns import (growth, half_up_quotient, hundredths, scaled,
                                          scaled_mean, units, weighted_score)
from trendspark.operators.ranking import percentile_score, with_ranks

DATE = "trending_date_parsed"
MARKET_DAY = ("region", DATE)


def _unbounded(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def add_category_name(df: DataFrame, reference: DataFrame) -> DataFrame:
    """``category_name`` of each row's category in its market, or a label made of the id.

    The reference is reduced to one title (the smallest) per category and market; the optimizer chooses the join from
    real sizes at run time, so nothing runs while the plan is built.
    """
    titles = reference.groupBy(F.expr("try_cast(id AS BIGINT)").alias("category_id"), "region").agg(
        F.min("snippet_title").alias("_title"))
    named = df.join(titles.where("category_id IS NOT NULL"), ["category_id", "region"], "left")
    return named.select(*df.columns, F.expr(
        "coalesce(_title, 'Unknown Category ' || CAST(category_id AS STRING))").alias("category_name"))


def build_trending_analytics(df: DataFrame) -> DataFrame:
    """Per market and date: volume, totals, exact means, distinct counts."""
    return df.groupBy(*MARKET_DAY).agg(
        F.count("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("dislikes").alias("total_dislikes"),
        F.sum("comment_count").alias("total_comments"),
        (F.sum("views") / F.count("views")).alias("avg_views_per_video"),
        scaled_mean("like_ratio", 10_000).alias("avg_like_ratio"),
        scaled_mean("engagement_rate", 10_000).alias("avg_engagement_rate"),
        F.max("views").alias("max_views"),
        F.count_distinct("channel_title").alias("unique_channels"),
        F.count_distinct("category_id").alias("unique_categories"),
    )


def channel_daily(df: DataFrame) -> DataFrame:
    """One row per (channel key, market, date); key = channel id, else title.

    ``engagement_units`` is the day's mean engagement rate in millionths of a
    percent, held as an integer so the cumulative mean is exact.
    """
    keyed = df.withColumn("channel_key", F.coalesce(F.col("channel_id"), F.col("channel_title")))
    # pre-aggregate per title with hash aggregation (numeric buffers only);
    # the string max over titles then runs on the already reduced rows
    per_title = keyed.groupBy("channel_key", *MARKET_DAY, "channel_title").agg(
        F.sum("views").alias("v"), F.sum("likes").alias("l"), F.sum("comment_count").alias("c"),
        F.sum(units("engagement_rate", 10_000)).alias("eu"),
        F.count("engagement_rate").alias("en"), F.max("views").alias("pv"))
    daily = per_title.groupBy("channel_key", *MARKET_DAY).agg(
        F.max("channel_title").alias("channel_title"),
        F.sum("v").alias("daily_views"),
        F.sum("l").alias("daily_likes"),
        F.sum("c").alias("daily_comments"),
        F.sum("eu").alias("_eu"), F.sum("en").alias("_en"),
        F.max("pv").alias("daily_peak_views"),
    )
    eng_units = F.expr(f"CAST({half_up_quotient('_eu', '_en', 100)} AS BIGINT)")
    return daily.select("channel_key", *MARKET_DAY, "channel_title", "daily_views", "daily_likes",
                        "daily_comments", eng_units.alias("engagement_units"), "daily_peak_views")


def channel_new_videos(df: DataFrame) -> DataFrame:
    """Videos seen for the first time per (channel key, market, date).

    Two aggregations (first date per video, then a count) replace a windowed
    running distinct count, which Spark does not support.
    """
    keyed = df.withColumn("channel_key", F.coalesce(F.col("channel_id"), F.col("channel_title")))
    first = keyed.groupBy("channel_key", "region", "video_id").agg(F.min(DATE).alias(DATE))
    return first.groupBy("channel_key", *MARKET_DAY).agg(
        F.count(F.lit(1)).alias("new_distinct_videos"))


def build_channel_analytics(df: DataFrame, cfg: TrendConfig = DEFAULT) -> DataFrame:
    daily = channel_daily(df).join(
        channel_new_videos(df), on=["channel_key", *MARKET_DAY], how="left"
    ).withColumn("new_distinct_videos", F.coalesce(F.col("new_distinct_videos"), F.lit(0).cast("long")))

    series = Window.partitionBy("channel_key", "region").orderBy(DATE)
    cum = _unbounded(series)
    ch = daily.select(
        F.col("channel_key").alias("channel_id"),
        "channel_title", "region", F.col(DATE).alias("snapshot_date"),
        F.sum("new_distinct_videos").over(cum).alias("trending_video_count_to_date"),
        F.sum("daily_views").over(cum).alias("total_views_to_date"),
        F.sum("daily_likes").over(cum).alias("total_likes_to_date"),
        F.sum("daily_comments").over(cum).alias("total_comments_to_date"),
        (F.sum("engagement_units").over(cum) / (F.count(F.lit(1)).over(cum) * 1_000_000.0))
        .alias("avg_engagement_rate_to_date"),
        F.max("daily_peak_views").over(cum).alias("peak_views_to_date"),
        F.row_number().over(series).alias("days_active_to_date"),
        F.min(DATE).over(cum).alias("first_trending_date"),
    )
    ch = ch.withColumns({
        "avg_views_per_video_to_date": F.expr(
            "CASE WHEN trending_video_count_to_date > 0 THEN "
            f"{scaled('total_views_to_date', 'trending_video_count_to_date', 2)} ELSE 0.0D END"),
        # active days / calendar days since the first appearance (inclusive)
        "trending_frequency": F.expr(scaled(
            "days_active_to_date", "datediff(snapshot_date, first_trending_date) + 1", 4)),
    })
    # markets-present (per channel) first: the rank, the percentile and a later
    # top-N then share one (market, date) partitioning
    ch = add_markets_present(ch)
    # rank and percentile of the same value come from one histogram
    ch = with_ranks(ch, ["region", "snapshot_date"], "total_views_to_date",
                    {"rank_in_region": ("row_number", True), "views_percentile": ("percent_score", False)},
                    tie_break=["channel_id"])
    return add_channel_trend_score(ch, cfg)


def add_markets_present(channel: DataFrame) -> DataFrame:
    """Distinct markets a channel has trended in, cumulative to each date.

    A market enters on the first date of its (channel, market) series
    (``days_active_to_date == 1``); a
    running sum of entries over the channel's dates (RANGE frame, so all
    markets of the same date count) replaces a range join of dates to entry
    dates.
    """
    entry = (F.col("days_active_to_date") == 1).cast("long")
    by_date = (Window.partitionBy("channel_id").orderBy("snapshot_date")
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (channel.withColumn("_entry", entry)
            .withColumn("markets_present", F.sum("_entry").over(by_date))
            .drop("_entry"))


def add_channel_trend_score(channel: DataFrame, cfg: TrendConfig = DEFAULT) -> DataFrame:
    """70 % views percentile in market+date, 30 % trending frequency (0-100)."""
    if "views_percentile" not in channel.columns:
        channel = percentile_score(channel, ["region", "snapshot_date"], "total_views_to_date", "views_percentile")
    wp, wf = cfg.channel_weights
    freq_pct = F.rint(F.col("trending_frequency") * 10_000) / 100.0
    return channel.withColumn(
        "trend_score",
        weighted_score([(F.col("views_percentile"), wp), (freq_pct, wf)], wp + wf))


def build_category_analytics(df: DataFrame, cfg: TrendConfig = DEFAULT) -> DataFrame:
    # the name is a function of (category, market) after the lookup, so it is
    # a grouping key rather than a (sort-based) string aggregate
    cat = df.groupBy("category_id", *MARKET_DAY, "category_name").agg(
        F.count("video_id").alias("video_count"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
        scaled_mean("engagement_rate", 10_000).alias("avg_engagement_rate"),
        F.count_distinct("channel_title").alias("unique_channels"),
    )
    market_day = Window.partitionBy(*MARKET_DAY)
    cat = cat.withColumn("_day_total", F.sum("total_views").over(market_day)).withColumn(
        "view_share_pct",
        F.expr(f"CASE WHEN _day_total > 0 THEN {scaled('total_views', '_day_total', 2, times=100)} END"),
    ).drop("_day_total")
    # rank first: then every (category, market) series function shares one sort
    # (categories of a market-day are few, so their rank is a plain window)
    cat = cat.withColumn("category_rank", F.dense_rank().over(market_day.orderBy(F.col("total_views").desc_nulls_last())))
    series = Window.partitionBy("category_id", "region").orderBy(DATE)
    cat = cat.withColumns({
        "previous_total_views": F.lag("total_views").over(series),
        "previous_rank": F.lag("category_rank").over(series),
    })
    cat = cat.withColumn("category_growth_pct",
                         growth("total_views", "previous_total_views", 2, times=100))
    # mean of the last N growth values (NULLs skipped) at 2 places, exact
    frame = series.rowsBetween(-(cfg.momentum_snapshots - 1), Window.currentRow)
    cat = cat.withColumns({
        "_m_sum": F.sum(hundredths("category_growth_pct")).over(frame),
        "_m_n": F.count("category_growth_pct").over(frame),
    }).withColumn("category_momentum", F.expr(
        f"CASE WHEN _m_n > 0 THEN {half_up_quotient('_m_sum', '_m_n')} / 100.0D END"
    )).drop("_m_sum", "_m_n")
    cat = cat.withColumn("rank_change", F.col("previous_rank") - F.col("category_rank"))
    return cat.withColumnRenamed(DATE, "snapshot_date")


def market_heatmap(category: DataFrame, markets: Sequence[str] = DEFAULT.markets) -> DataFrame:
    """Views of each category by market, a column for each of ``markets`` (null where a category is absent there);
    markets that are not listed are left out. The list is given, so no job looks for the values."""
    return category.groupBy("category_name").pivot("region", list(markets)).agg(F.sum("total_views"))
