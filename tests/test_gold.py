import datetime as dt

from trendspark.operators import gold

D1, D2, D3, D4 = (dt.date(2026, 7, d) for d in (15, 16, 17, 18))


def test_category_lookup_with_fallback(spark):
    stats = spark.createDataFrame([(10, "us", "v1", 5), (20, "us", "v2", 6), (999, "us", "v3", 7)],
                                  "category_id long, region string, video_id string, views long")
    ref = spark.createDataFrame([("10", "Music", "us"), ("20", "Sports", "us"), ("20", "Sports", "us"),
                                 ("10", "Music", "gb")], "id string, snippet_title string, region string")
    out = {r.video_id: r.category_name for r in gold.add_category_name(stats, ref).collect()}
    assert out == {"v1": "Music", "v2": "Sports", "v3": "Unknown Category 999"}


def test_category_lookup_plan_broadcasts_reference(spark):
    stats = spark.createDataFrame([(10, "us", "v1")], "category_id long, region string, video_id string")
    ref = spark.createDataFrame([("10", "Music", "us")], "id string, snippet_title string, region string")
    plan = gold.add_category_name(stats, ref)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" not in plan


def test_trending_rollup(spark):
    df = spark.createDataFrame([
        ("v1", "us", D1, 100, 10, 1, 5, 10.0, 16.0, "c1", 1),
        ("v2", "us", D1, 300, 30, 3, 15, 10.0, 16.0, "c1", 2),
    ], "video_id string, region string, trending_date_parsed date, views long, likes long, "
       "dislikes long, comment_count long, like_ratio double, engagement_rate double, "
       "channel_title string, category_id long")
    r = gold.build_trending_analytics(df).first()
    assert (r.total_videos, r.total_views, r.max_views, r.unique_channels, r.unique_categories) == (2, 400, 300, 1, 2)
    assert r.avg_views_per_video == 200.0 and r.avg_engagement_rate == 16.0


def _channel_rows(spark, rows):
    return spark.createDataFrame(rows, (
        "video_id string, region string, channel_title string, channel_id string, "
        "trending_date_parsed date, category_name string, views long, likes long, "
        "comment_count long, engagement_rate double"))


def test_channel_cumulative_and_rank(spark):
    df = _channel_rows(spark, [
        ("v1", "us", "A", "c1", D1, "Music", 300, 1, 1, 1.0),
        ("v2", "us", "A", "c1", D2, "Music", 200, 1, 1, 3.0),
        ("v1", "us", "A", "c1", D2, "Music", 0, 0, 0, 0.0),
        ("v3", "us", "B", "c2", D1, "Music", 100, 1, 1, 1.0),
    ])
    out = {(r.channel_id, r.snapshot_date): r for r in gold.build_channel_analytics(df).collect()}
    a1, a2, b1 = out[("c1", D1)], out[("c1", D2)], out[("c2", D1)]
    assert (a1.total_views_to_date, a2.total_views_to_date) == (300, 500)
    assert (a1.trending_video_count_to_date, a2.trending_video_count_to_date) == (1, 2)
    assert (a1.rank_in_region, b1.rank_in_region) == (1, 2)
    assert a2.avg_views_per_video_to_date == 250.0
    # mean of daily means: day 1 = 1.0, day 2 = (3.0 + 0.0) / 2
    assert a2.avg_engagement_rate_to_date == 1.25
    assert a2.peak_views_to_date == 300 and a2.first_trending_date == D1


def test_channel_frequency(spark):
    straight = [("v1", "us", "A", "c1", d, "m", 10, 1, 1, 1.0) for d in (D1, D2, D3)]
    gap = [("v2", "us", "B", "c2", d, "m", 10, 1, 1, 1.0) for d in (D1, D2, dt.date(2026, 7, 19))]
    out = {(r.channel_id, r.snapshot_date): r
           for r in gold.build_channel_analytics(_channel_rows(spark, straight + gap)).collect()}
    assert out[("c1", D3)].trending_frequency == 1.0
    assert out[("c2", dt.date(2026, 7, 19))].trending_frequency == 0.6
    for r in out.values():
        assert r.trending_frequency <= 1.0


def test_channel_key_falls_back_to_title(spark):
    df = _channel_rows(spark, [("v1", "us", "Legacy", None, D1, "m", 10, 1, 1, 1.0)])
    assert gold.build_channel_analytics(df).first().channel_id == "Legacy"


def test_renamed_channel_stays_one_row(spark):
    df = _channel_rows(spark, [("v1", "us", "Old", "c1", D1, "m", 10, 1, 1, 1.0),
                               ("v2", "us", "New", "c1", D1, "m", 20, 1, 1, 1.0)])
    rows = gold.build_channel_analytics(df).collect()
    assert len(rows) == 1 and rows[0].days_active_to_date == 1 and rows[0].trending_video_count_to_date == 2


def test_markets_present(spark):
    df = spark.createDataFrame([("c1", "us", D1), ("c1", "gb", D2), ("c1", "us", D2), ("c1", "us", D3)],
                               "channel_id string, region string, snapshot_date date")
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = df.withColumn("days_active_to_date", F.row_number().over(
        Window.partitionBy("channel_id", "region").orderBy("snapshot_date")))
    out = {(r.region, r.snapshot_date): r.markets_present for r in gold.add_markets_present(df).collect()}
    assert out == {("us", D1): 1, ("gb", D2): 2, ("us", D2): 2, ("us", D3): 2}


def test_channel_trend_score(spark):
    df = spark.createDataFrame([("c1", "us", D1, 1000, 1.0), ("c2", "us", D1, 500, 0.5)],
                               "channel_id string, region string, snapshot_date date, "
                               "total_views_to_date long, trending_frequency double")
    out = {r.channel_id: r.trend_score for r in gold.add_channel_trend_score(df).collect()}
    assert out == {"c1": 100.0, "c2": 15.0}


def _cat_rows(spark, rows):
    return spark.createDataFrame(rows, (
        "video_id string, region string, category_name string, category_id long, channel_title string, "
        "trending_date_parsed date, views long, likes long, comment_count long, engagement_rate double"))


def test_category_share_growth_rank(spark):
    df = _cat_rows(spark, [
        ("v1", "us", "Music", 10, "a", D1, 300, 1, 1, 1.0),
        ("v2", "us", "Sports", 17, "b", D1, 100, 1, 1, 1.0),
        ("v1", "us", "Music", 10, "a", D2, 450, 1, 1, 1.0),
        ("v2", "us", "Sports", 17, "b", D2, 900, 1, 1, 1.0),
    ])
    out = {(r.category_id, r.snapshot_date): r for r in gold.build_category_analytics(df).collect()}
    assert out[(10, D1)].view_share_pct == 75.0
    assert out[(10, D1)].category_growth_pct is None and out[(10, D2)].category_growth_pct == 50.0
    s2 = out[(17, D2)]
    assert (s2.category_rank, s2.previous_rank, s2.rank_change) == (1, 2, 1)
    assert s2.category_growth_pct == 800.0 and s2.category_momentum == 800.0


def test_category_zero_baseline_and_momentum(spark):
    df = _cat_rows(spark, [
        ("v1", "us", "Music", 10, "a", D1, 0, 0, 0, 0.0),
        ("v1", "us", "Music", 10, "a", D2, 100, 0, 0, 0.0),
        ("v1", "us", "Music", 10, "a", D3, 200, 0, 0, 0.0),
        ("v1", "us", "Music", 10, "a", D4, 600, 0, 0, 0.0),
    ])
    out = {r.snapshot_date: r for r in gold.build_category_analytics(df).collect()}
    assert out[D2].category_growth_pct is None
    assert out[D3].category_growth_pct == 100.0 and out[D4].category_growth_pct == 200.0
    assert out[D3].category_momentum == 100.0 and out[D4].category_momentum == 150.0
