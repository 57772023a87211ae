"""Records found again in swallowed CSV text, and quantiles merged from stored sketches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from trendspark.operators import sketches
from trendspark.sources import snapshots

HEADER = ",".join(snapshots.CSV_COLUMNS)


def record(vid, description='"d"', views="1", title="T"):
    return f"{vid},17.14.11,{title},C,22,2017-11-13T05:11:58.000Z,t,{views},2,3,4,http://z,FALSE,FALSE,False,{description}"


def landed(tmp_path, *records):
    folder = tmp_path / "csv" / "region=mx"
    folder.mkdir(parents=True)
    (folder / "videos.csv").write_text("\n".join([HEADER, *records]) + "\n")
    return str(tmp_path / "csv")


def test_only_the_broken_row_is_quarantined(spark, tmp_path):
    path = landed(tmp_path, record("aaaaaaaaaaa"), record("brokenbroke", '"unclosed'), record("ccccccccccc", "plain", "77"), record("ddddddddddd", "x"))
    rows, lost = snapshots.read_snapshots_csv(spark, path, recover=True)
    got = {r.video_id: (r.views, r.description, r.region) for r in rows.collect()}
    assert got == {"aaaaaaaaaaa": ("1", "d", "mx"), "ccccccccccc": ("77", "plain", "mx"), "ddddddddddd": ("1", "x", "mx")}
    left = lost.collect()
    assert [(r.video_id, r.region) for r in left] == [("brokenbroke", "mx")] and "ccccccccccc" not in str(left)


def test_quoted_records_after_an_open_quote_are_found(spark, tmp_path):
    path = landed(tmp_path, record("brokenbroke", '"unclosed'), record("ccccccccccc", '"two\nlines, ""quoted"""', "5", '"a, b"'), record("ddddddddddd"))
    rows, lost = snapshots.read_snapshots_csv(spark, path, recover=True)
    got = {r.video_id: (r.title, r.views, r.description) for r in rows.collect()}
    held = " ".join(str(r) for r in lost.collect())
    for vid, want in {"ccccccccccc": ("a, b", "5", 'two\nlines, "quoted"'), "ddddddddddd": ("T", "1", "d")}.items():
        assert got.get(vid, want) == want and (vid in got) != (vid in held)  # right or still in quarantine, never lost
    assert "brokenbroke" in held


def test_pieces_that_are_no_whole_record_stay_in_quarantine(spark):
    text = "\n".join([record("brokenbroke", '"open'), record("aaaaaaaaaaa"), record("bbbbbbbbbbb", views="many"), "ccccccccccc,17.14.11,short", record("ddddddddddd", '"open too')])
    bad = spark.createDataFrame([{"_corrupt_record": text, "region": "mx"}], ", ".join(f"{c} string" for c in (*snapshots.CSV_COLUMNS, "_corrupt_record", "region")))
    recovered, lost = snapshots.recover_swallowed(bad)
    assert [r.video_id for r in recovered.collect()] == ["aaaaaaaaaaa"]
    assert sorted(r._corrupt_record[:11] for r in lost.collect()) == ["bbbbbbbbbbb", "brokenbroke", "ccccccccccc", "ddddddddddd"]
    assert recovered.columns == [*snapshots.CSV_COLUMNS, "region"]


def trend_rows(n):
    rng = random.Random(3)
    stages = ["viral", "rising", "rising", "rising"]  # one stage holds most rows
    return [(rng.choice(["us", "gb"]), rng.choice(stages), f"2026-01-{rng.randint(1, 30):02d}", rng.choice([None, rng.gauss(0, 5), 1.5])) for _ in range(n)]


SCHEMA = "region string, trend_stage string, snapshot_date string, view_growth_rate double"


def test_medians_from_stored_sketches(spark, tmp_path):
    root = str(tmp_path / "sketches")
    trends = spark.createDataFrame(trend_rows(30_000), SCHEMA).withColumn("snapshot_date", F.to_date("snapshot_date"))
    stored = sketches.run_sketches(trends, root)
    assert set(stored.columns) == {"region", "trend_stage", "snapshot_date", "growth_count", "growth_sketch"} and stored.count() == 120
    whole = sketches.bound_check(trends, sketches.median_growth(spark, root))
    assert whole.count() == 4 and whole.where("NOT within_bound").isEmpty()
    days = F.col("snapshot_date").between("2026-01-05", "2026-01-09")
    some = sketches.median_growth(spark, root, days)
    assert sketches.bound_check(trends.where(days), some).where("within_bound").count() == 4
    assert "PartitionFilters: [isnotnull(snapshot_date" in some._jdf.queryExecution().toString()


def test_small_groups_are_exact_and_groups_without_growth_have_no_row(spark):
    rows = [("us", "new", "2026-01-01", None)] + [("us", "up", f"2026-01-0{1 + i % 3}", float(i)) for i in range(101)]
    merged = sketches.merged_quantile(sketches.growth_sketches(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [tuple(r) for r in merged] == [("us", "up", 101, 50.0)]
