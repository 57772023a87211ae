import datetime as dt

import pytest

from trendspark.operators import quality


def _clean(spark, n=15, null_titles=0, views=None):
    rows = [(f"v{i}", None if i < null_titles else f"t{i}", "c", (views or {}).get(i, 100 + i), "us")
            for i in range(n)]
    return spark.createDataFrame(rows, "video_id string, title string, channel_title string, "
                                       "views long, region string")


def _by(results, check, column=None):
    return [r for r in results if r["check"] == check and (column is None or r.get("column") == column)]


def test_row_count_and_schema(spark):
    res = quality.check_table(_clean(spark), "clean_statistics")
    assert _by(res, "row_count")[0]["passed"]
    assert _by(res, "schema")[0]["passed"]
    # a required column is missing -> schema and null check fail
    res2 = quality.check_table(_clean(spark).drop("views"), "clean_statistics")
    assert not _by(res2, "schema")[0]["passed"]
    assert not _by(res2, "null_pct", "views")[0]["passed"]


def test_row_count_threshold(spark):
    from trendspark.config import TrendConfig
    res = quality.check_table(_clean(spark), "clean_statistics", TrendConfig(dq_min_rows=100))
    assert not _by(res, "row_count")[0]["passed"]


def test_null_share(spark):
    res = quality.check_table(_clean(spark, null_titles=6), "clean_statistics")
    r = _by(res, "null_pct", "title")[0]
    assert r["value"] == 40.0 and not r["passed"]


def test_value_ranges(spark):
    res = quality.check_table(_clean(spark, views={0: 99_999_999_999, 1: -5}), "clean_statistics")
    r = _by(res, "value_range")[0]
    assert (r["negative_count"], r["extreme_count"], r["passed"]) == (1, 1, False)


def test_uniqueness_counts_all_copies(spark):
    d = dt.date(2026, 7, 17)
    df = spark.createDataFrame([("a", "us", d), ("a", "us", d), ("b", "us", d)],
                               "video_id string, region string, trending_date_parsed date")
    r = _by(quality.check_table(df, "clean_statistics"), "uniqueness")[0]
    assert r["duplicate_row_count"] == 2 and not r["passed"]
    skipped = _by(quality.check_table(df.drop("region"), "clean_statistics"), "uniqueness")[0]
    assert skipped["passed"]


def test_metric_bounds(spark):
    df = spark.createDataFrame([(150.0,), (-5.0,), (None,), (50.0,)], "trend_score double")
    r = _by(quality.check_table(df, "trend_opportunities"), "metric_sanity", "trend_score")[0]
    assert r["out_of_bounds_count"] == 2 and not r["passed"]


@pytest.mark.parametrize("offset_h,passed", [(0, True), (-72, False)])
def test_freshness(spark, offset_h, passed):
    now = dt.datetime(2026, 7, 17, 12, tzinfo=dt.timezone.utc)
    ts = (now + dt.timedelta(hours=offset_h)).replace(tzinfo=None)
    df = spark.createDataFrame([(ts,)], "_processed_at timestamp")
    assert _by(quality.check_table(df, "x", now=now), "freshness")[0]["passed"] is passed


def test_freshness_missing_or_junk_passes(spark):
    assert _by(quality.check_table(spark.createDataFrame([(1,)], "x int"), "x"), "freshness")[0]["passed"]
    junk = spark.createDataFrame([("junk",)], "_ingestion_timestamp string")
    assert _by(quality.check_table(junk, "x"), "freshness")[0]["passed"]


def test_aggregated_at_counts_for_freshness(spark):
    now = dt.datetime(2026, 7, 17, 12, tzinfo=dt.timezone.utc)
    old = spark.createDataFrame([(dt.datetime(2026, 7, 1),)], "_aggregated_at timestamp")
    assert not _by(quality.check_table(old, "trend_opportunities", now=now), "freshness")[0]["passed"]


def test_summary_and_gate(spark):
    good = quality.run_checks({"clean_statistics": _clean(spark)},
                              now=dt.datetime.now(dt.timezone.utc))
    assert good["quality_passed"] and good["quality_score"] == 100.0
    assert isinstance(good["checks_total"], int)
    bad = quality.run_checks({"clean_statistics": _clean(spark, null_titles=6)})
    assert not bad["quality_passed"] and 0 < bad["quality_score"] < 100
    with pytest.raises(quality.QualityGateError):
        quality.assert_quality(bad)


def test_unreadable_table_is_failed_check(spark):
    class Broken:
        columns = ["x"]

        def agg(self, *a):
            raise RuntimeError("no such table")

    res = quality.run_checks({"missing": Broken()})
    assert res["details"][0]["check"] == "read_table" and not res["quality_passed"]


def test_freshness_does_not_depend_on_the_time_zone(tmp_path):
    """A driver west of UTC reads the same age."""
    import os
    import subprocess
    import sys
    code = """
import datetime as dt
from trendspark.session import build_session
from trendspark.operators import quality
spark = build_session(master="local[1]", shuffle_partitions=1)
df = spark.sql("SELECT TIMESTAMP '2026-07-15 14:00:00' AS _processed_at")
r = [x for x in quality.check_table(df, "x", now=dt.datetime(2026, 7, 17, 12, tzinfo=dt.timezone.utc)) if x["check"] == "freshness"][0]
assert r["passed"] and r["latest_record"].startswith("2026-07-15 14:00"), r
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "TZ": "America/New_York", "PYTHONPATH": root}
    assert subprocess.run([sys.executable, "-c", code], cwd=root, env=env, timeout=300).returncode == 0


def test_a_missing_path_is_a_failed_check(spark, tmp_path):
    found = quality.run_checks({"video_trends": str(tmp_path / "nothing")})
    assert [r["check"] for r in found["details"]] == ["read_table"] and not found["quality_passed"]


def test_profile_observed_in_the_write_gives_the_same_report(spark, tmp_path):
    from pyspark.sql import functions as F

    from trendspark.sinks import write_table
    frames = [_clean(spark, 40, null_titles=6, views={1: -5, 2: 10**15}), _clean(spark, 12), _clean(spark, 12).limit(0)]
    for i, frame in enumerate(frames):
        frame = frame.withColumn("_processed_at", F.lit("2026-01-01 00:00:00").cast("timestamp")).drop("channel_title")
        metrics, stamp = quality.profile_metrics(frame.columns, "clean_statistics")
        path, now = str(tmp_path / str(i)), dt.datetime(2026, 1, 2, tzinfo=dt.timezone.utc)
        seen = write_table(frame, path, ("region",), metrics=metrics)
        profile = {"row": seen, "ts_column": stamp, "columns": set(frame.columns)}
        written = spark.read.schema(frame.schema).parquet(path)
        got = quality.check_table(written, "clean_statistics", now=now, profile=profile)
        assert got == quality.check_table(written, "clean_statistics", now=now)
