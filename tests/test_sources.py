import datetime as dt
import json
import os

from pyspark.sql import functions as F

from trendspark.sources import reference, snapshots


def _doc(items, region="us", ingestion_id="i1", ts="2026-07-17T03:00:00Z"):
    return {"items": items, "_pipeline_metadata": {"ingestion_id": ingestion_id, "region": region,
                                                   "ingestion_timestamp": ts, "source": "api"}}


def _item(vid, views, title="T", duration="PT4M13S"):
    return {"id": vid, "snippet": {"title": title, "channelTitle": "Chan", "channelId": "UC1",
                                   "categoryId": "10", "publishedAt": "2026-07-16T12:00:00Z",
                                   "tags": ["a", "b"], "description": "d",
                                   "thumbnails": {"default": {"url": "http://t"}}},
            "statistics": {"viewCount": str(views), "likeCount": "10", "commentCount": "2"},
            "contentDetails": {"duration": duration, "definition": "hd", "caption": "false"}}


def _land(base, region, date, hour, doc, name="x.json"):
    d = os.path.join(base, f"region={region}", f"date={date}", f"hour={hour:02d}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        json.dump(doc, fh)


def test_landed_json_to_silver(spark, tmp_path):
    base = str(tmp_path / "landing")
    _land(base, "us", "2026-07-17", 3, _doc([_item("v1", 100), _item("v2", 50)]))
    _land(base, "us", "2026-07-17", 5, _doc([_item("v1", 120, title="newer")], ingestion_id="i2"))
    _land(base, "gb", "2026-07-17", 3, _doc([_item("v1", 7)], region="gb"))
    _land(base, "de", "2026-07-17", 3, _doc([_item("v9", 7)], region="de"))
    env = snapshots.read_snapshot_envelopes(spark, base, markets=["us", "gb"])
    silver = snapshots.api_to_silver(snapshots.flatten_items(env))
    rows = {(r.video_id, r.region): r for r in silver.collect()}
    assert set(rows) == {("v1", "us"), ("v2", "us"), ("v1", "gb")}
    v1 = rows[("v1", "us")]
    assert v1.title == "newer" and v1.views == 120  # the later landing hour wins
    assert v1.trending_date_parsed == dt.date(2026, 7, 17)  # from the partition, not the clock
    assert v1.duration_seconds == 253 and v1.tags == "a|b" and v1.dislikes == 0
    assert v1.video_age_hours == 12.0


def test_market_filter_prunes_partitions(spark, tmp_path):
    base = str(tmp_path / "landing")
    _land(base, "us", "2026-07-17", 3, _doc([_item("v1", 100)]))
    env = snapshots.read_snapshot_envelopes(spark, base, markets=["us"])
    plan = env._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "region" in plan


def test_legacy_csv_with_quotes_and_newlines(spark, tmp_path):
    d = tmp_path / "csv" / "region=mx"
    d.mkdir(parents=True)
    header = ("video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,"
              "dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,"
              "video_error_or_removed,description")
    good = ('SbOwzAl9ZfQ,17.14.11,Cap 12,MasterChef,24,2017-11-13T06:06:22.000Z,'
            '"a|""b""|""c""",310130,4182,361,1836,http://x,FALSE,FALSE,FALSE,"line1\nline2"')
    swallow = ('klOV6Xh-DnI,17.14.11,T,C,22,2017-11-13T05:11:58.000Z,t,104972,271,174,369,'
               'http://y,FALSE,FALSE,FALSE,"unclosed\n'
               'abcdefghijk,17.14.11,T2,C2,22,2017-11-13T05:11:58.000Z,t,1,1,1,1,http://z,FALSE,FALSE,FALSE,x')
    (d / "videos.csv").write_text("\n".join([header, good, swallow]) + "\n")
    rows, quarantined = snapshots.read_snapshots_csv(spark, str(tmp_path / "csv"))
    got = rows.collect()
    assert len(got) == 1 and got[0].tags == 'a|"b"|"c"' and got[0].region == "mx"
    assert got[0].description == "line1\nline2"
    assert quarantined.count() == 1


def test_region_from_path(spark):
    df = spark.createDataFrame([("s3://b/p/region=US/date=2026-07-17/f.json",), ("/tmp/f.json",)], "p string")
    assert [r.r for r in df.select(snapshots.region_from_path(F.col("p")).alias("r")).collect()] == ["US", "unknown"]


def _write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(obj, fh)


def test_reference_flatten_keeps_last_duplicate(spark, tmp_path):
    base = tmp_path / "ref"
    _write_json(str(base / "region=us" / "date=2026-07-17" / "us.json"), {
        "kind": "list", "etag": "e", "items": [
            {"kind": "cat", "etag": "1", "id": "10", "snippet": {"title": "Music", "assignable": True}},
            {"kind": "cat", "etag": "2", "id": "17", "snippet": {"title": "Sports", "assignable": True}},
            {"kind": "cat", "etag": "3", "id": "17", "snippet": {"title": "Sports v2", "assignable": True}}]})
    out = reference.read_reference(spark, str(base), ingested_at=F.lit("2026-07-17 00:00:00").cast("timestamp"))
    rows = {r.id: r for r in out.collect()}
    assert set(rows) == {"10", "17"}
    assert rows["17"].snippet_title == "Sports v2" and rows["10"].region == "us"
    assert "snippet_assignable" in out.columns and rows["10"]._ingestion_timestamp == "2026-07-17T00:00:00Z"


def test_reference_outcome(spark, tmp_path):
    base = tmp_path / "ref"
    _write_json(str(base / "region=us" / "date=2026-07-17" / "us.json"),
                {"items": [{"id": "1", "snippet": {"title": "Film & Animation"}}]})
    _write_json(str(base / "region=gb" / "date=2026-07-16" / "gb.json"),
                {"items": [{"id": "2", "snippet": {"title": "Autos & Vehicles"}}]})
    _write_json(str(base / "region=in" / "date=2026-07-17" / "in.json"),
                {"items": [{"id": "1", "snippet": {"title": "Film & Animation"}}]})
    out = reference.reference_outcome(spark, str(base), "2026-07-17")
    assert sorted(r.region for r in out.collect()) == ["in", "us"]
    import pytest
    with pytest.raises(RuntimeError):
        reference.reference_outcome(spark, str(base), "2020-01-01")


def test_reference_outcome_empty_document_fails(spark, tmp_path):
    import pytest
    base = tmp_path / "ref"
    _write_json(str(base / "region=us" / "date=2026-07-17" / "us.json"), {"kind": "list", "items": []})
    with pytest.raises(RuntimeError):
        reference.reference_outcome(spark, str(base), "2026-07-17")
    _write_json(str(base / "region=gb" / "date=2026-07-17" / "gb.json"),
                {"items": [{"id": "2", "snippet": {"title": "Autos & Vehicles"}}]})
    out = {r.region: r.ok for r in reference.reference_outcome(spark, str(base), "2026-07-17").collect()}
    assert out == {"us": False, "gb": True}


def test_reference_document_without_items_is_one_row(spark, tmp_path):
    base = tmp_path / "ref"
    _write_json(str(base / "region=us" / "date=2026-07-17" / "a.json"),
                {"items": [{"id": "1", "snippet": {"title": "Film & Animation"}}]})
    _write_json(str(base / "region=kr" / "date=2026-07-17" / "b.json"), {"id": "24", "kind": "single"})
    flat = {r.region: r.id for r in reference.read_reference(spark, str(base), "2026-07-17").collect()}
    assert flat == {"us": "1", "kr": "24"}
    ok = {r.region: r.ok for r in reference.reference_outcome(spark, str(base), "2026-07-17").collect()}
    assert ok == {"us": True, "kr": True}
