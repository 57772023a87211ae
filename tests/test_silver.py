import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendspark.operators import silver


def test_duration_seconds(spark):
    df = spark.createDataFrame([("PT4M13S",), ("PT1H2M3S",), ("PT45S",), (None,)], "duration string")
    got = [r.duration_seconds for r in silver.add_duration_seconds(df).collect()]
    assert got == [253, 3723, 45, None]


def test_duration_missing_column(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert silver.add_duration_seconds(df).first().duration_seconds is None


def test_rate_metrics(spark):
    df = spark.createDataFrame([(1000, 50, 10), (100, 10, 5), (0, 5, 5), (None, 1, 1)],
                               "views long, likes long, comment_count long")
    rows = silver.add_rate_metrics(df).collect()
    assert [(r.like_rate, r.comment_rate) for r in rows] == [
        (0.05, 0.01), (0.1, 0.05), (0.0, 0.0), (0.0, 0.0)]


def test_velocity_context(spark):
    d = dt.date(2026, 7, 17)
    df = spark.createDataFrame([
        ("2026-07-16T12:00:00Z", d, 2400),
        ("2026-07-17T23:30:00Z", d, 500),
        (None, d, 100),
        ("2026-07-16T22:00:00Z", d, 300),
    ], "publish_time string, trending_date_parsed date, views long")
    rows = silver.add_velocity_context(df).collect()
    assert rows[0].video_age_hours == 12.0 and rows[0].views_per_hour == 200.0
    assert rows[1].video_age_hours == -23.5 and rows[1].views_per_hour == 500.0
    assert rows[2].video_age_hours is None and rows[2].views_per_hour is None
    assert rows[3].video_age_hours == 2.0 and rows[3].views_per_hour == 150.0


def test_velocity_unparseable_is_null(spark):
    df = spark.createDataFrame([("junk", dt.date(2026, 1, 1), 5)],
                               "publish_time string, trending_date_parsed date, views long")
    assert silver.add_velocity_context(df).first().video_age_hours is None


def test_cleanse(spark):
    df = spark.createDataFrame([
        (None, " US ", "17.14.11", "t", 100, 10, None, 1),
        ("v1", " US ", "17.14.11", "t", 100, 10, None, 1),
        ("v2", "gb", "2026-07-17", "t", 0, 0, 0, 0),
        ("v3", "gb", "24.07.17", "t", 10, 1, 1, 1),
    ], "video_id string, region string, trending_date string, title string, views long, "
       "likes long, dislikes long, comment_count long")
    out = {r.video_id: r for r in silver.cleanse(df).collect()}
    assert set(out) == {"v1", "v2", "v3"}
    v1 = out["v1"]
    assert v1.region == "us" and v1.dislikes == 0 and v1.like_ratio == 10.0
    assert v1.engagement_rate == 11.0
    assert v1.trending_date_parsed == dt.date(2017, 11, 14)
    assert out["v2"].trending_date_parsed == dt.date(2026, 7, 17)
    assert out["v2"].like_ratio == 0.0 and out["v2"].engagement_rate == 0.0
    # month 17 does not exist: NULL instead of an ANSI error
    assert out["v3"].trending_date_parsed is None


def test_deduplicate_keeps_newest(spark):
    d = dt.date(2026, 7, 17)
    df = spark.createDataFrame([
        ("v1", "us", d, "old", dt.datetime(2026, 7, 17, 10)),
        ("v1", "us", d, "new", dt.datetime(2026, 7, 17, 11)),
        ("v2", "us", d, "only", dt.datetime(2026, 7, 17, 9)),
    ], "video_id string, region string, trending_date_parsed date, title string, _processed_at timestamp")
    out = {r.video_id: r.title for r in silver.deduplicate(df).collect()}
    assert out == {"v1": "new", "v2": "only"}


def test_deduplicate_is_order_independent(spark):
    d = dt.date(2026, 7, 17)
    t = dt.datetime(2026, 7, 17, 10)
    rows = [("v1", "us", d, f"copy{i}", t) for i in range(20)]
    schema = "video_id string, region string, trending_date_parsed date, title string, _processed_at timestamp"
    a = silver.deduplicate(spark.createDataFrame(rows, schema)).first().title
    b = silver.deduplicate(spark.createDataFrame(rows[::-1], schema).repartition(4)).first().title
    assert a == b == "copy9"


def test_quality_report(spark):
    df = spark.createDataFrame([("a", None, "c", 1), (None, "t", None, -5), ("b", "t", "c", None)],
                               "video_id string, title string, channel_title string, views long")
    rep = silver.quality_report(df)
    assert rep["nulls"] == {"video_id": 1, "title": 1, "channel_title": 1, "views": 1}
    assert rep["negative_views"] == 1


def test_api_layout_sparse(spark):
    df = spark.createDataFrame(
        [("vid1", "Title", "Chan", "10", "100", "7", "3", "us")],
        "id string, `snippet.title` string, `snippet.channelTitle` string, `snippet.categoryId` string, "
        "`statistics.viewCount` string, `statistics.likeCount` string, `statistics.commentCount` string, "
        "region string")
    assert silver.is_api_layout(df)
    r = silver.to_canonical(df, F.lit("2026-07-17").cast("date")).first()
    assert (r.video_id, r.category_id, r.views, r.likes, r.dislikes) == ("vid1", 10, 100, 7, 0)
    assert r.duration is None and r.trending_date == "2026-07-17"


def test_csv_layout_strings(spark):
    cols = ["video_id", "trending_date", "title", "channel_title", "category_id", "publish_time",
            "tags", "views", "likes", "dislikes", "comment_count", "thumbnail_link",
            "comments_disabled", "ratings_disabled", "video_error_or_removed", "description", "region"]
    row = ("SbOwzAl9ZfQ", "17.14.11", "t", "ch", "24", "2017-11-13T06:06:22.000Z", 'a|"b"',
           "310130", "4182", "361", "1836", "http://x", "FALSE", "FALSE", "FALSE", "d", "mx")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols))
    assert not silver.is_api_layout(df)
    r = silver.to_canonical(df).first()
    assert r.channel_id is None and r.duration is None and r.caption is None
    assert r.category_id == 24 and r.views == 310130 and r.comments_disabled is False
    assert r.tags == 'a|"b"' and r.publish_time == "2017-11-13T06:06:22.000Z"


def test_csv_bad_counter_is_null_not_error(spark):
    df = spark.createDataFrame([("v", "junk")], "video_id string, views string")
    assert silver.to_canonical(df).first().views is None
