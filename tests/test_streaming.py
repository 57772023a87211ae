import os

from trendspark.sources import snapshots
from trendspark.streaming.incremental import run_incremental_silver

from test_sources import _doc, _item, _land

KEY = ("video_id", "region", "trending_date_parsed")
COLS = ("video_id", "region", "trending_date_parsed", "title", "views", "likes", "duration_seconds")


def _rows(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def test_incremental_equals_batch_and_is_idempotent(spark, tmp_path):
    landing, silver = str(tmp_path / "landing"), str(tmp_path / "silver")
    ckpt = str(tmp_path / "ckpt")
    _land(landing, "us", "2026-07-17", 3, _doc([_item("v1", 100), _item("v2", 50)]), "a.json")
    _land(landing, "gb", "2026-07-17", 3, _doc([_item("v1", 7)], region="gb"), "b.json")
    first = run_incremental_silver(spark, landing, silver, ckpt)
    assert first.count() == 3
    # a later landing: v1 in us again (newer copy), a new date
    _land(landing, "us", "2026-07-17", 5, _doc([_item("v1", 120, title="newer")], ingestion_id="i2"), "c.json")
    _land(landing, "us", "2026-07-18", 3, _doc([_item("v1", 200)]), "d.json")
    second = run_incremental_silver(spark, landing, silver, ckpt)
    # rerun with nothing new: unchanged
    third = run_incremental_silver(spark, landing, silver, ckpt)
    batch = snapshots.api_to_silver(snapshots.flatten_items(
        snapshots.read_snapshot_envelopes(spark, landing)))
    assert _rows(second) == _rows(batch) == _rows(third)
    assert second.groupBy(*KEY).count().where("count > 1").count() == 0
    newer = [r for r in second.collect() if r.video_id == "v1" and r.region == "us"
             and str(r.trending_date_parsed) == "2026-07-17"]
    assert newer[0].title == "newer"


def test_default_stream_checkpoint_is_stable(spark):
    from trendspark.session import stream_checkpoint
    a = stream_checkpoint(spark, "incremental_silver_x")
    assert a == stream_checkpoint(spark, "incremental_silver_x") and a.endswith("streams/incremental_silver_x")


def test_late_files_and_missing_dates_equal_batch(spark, tmp_path):
    """An older copy that lands later does not win, in one or several batches; rows of no date are kept."""
    from pyspark.sql import functions as F

    from trendspark.streaming.incremental import merge_batch

    landing, table, ckpt = (str(tmp_path / x) for x in ("landing", "silver", "ckpt"))
    _land(landing, "us", "2026-07-17", 5, _doc([_item("v1", 120)], ingestion_id="i5"), "late.json")
    run_incremental_silver(spark, landing, table, ckpt)
    _land(landing, "us", "2026-07-17", 3, _doc([_item("v1", 100), _item("v2", 7)], ingestion_id="i3"), "early.json")
    got = run_incremental_silver(spark, landing, table, ckpt)
    batch = snapshots.api_to_silver(snapshots.flatten_items(snapshots.read_snapshot_envelopes(spark, landing)))
    assert _rows(got) == _rows(batch) and {r.video_id: r.views for r in got.collect()} == {"v1": 120, "v2": 7}

    undated = str(tmp_path / "undated")
    envelopes = snapshots.read_snapshot_envelopes(spark, landing).withColumn("date", F.lit(None).cast("date"))
    merge_batch(envelopes.where("hour = 5"), undated)
    merge_batch(envelopes.where("hour = 3"), undated)
    merge_batch(envelopes.where("hour = 3"), undated)
    assert {r.video_id: r.views for r in spark.read.parquet(undated).collect()} == {"v1": 120, "v2": 7}


def _landed(landing, n):
    for i in range(n):
        _land(landing, "us" if i % 2 else "gb", f"2026-07-{17 + i % 3}", i % 24, _doc([_item(f"v{i % 4}", 100 + i)], ingestion_id=f"i{i}"), f"{i}.json")


def test_a_backlog_is_drained_in_several_batches(spark, tmp_path):
    from trendspark.streaming.incremental import merged_batches

    landing, silver, ckpt = (str(tmp_path / x) for x in ("landing", "silver", "ckpt"))
    _landed(landing, 7)
    got = run_incremental_silver(spark, landing, silver, ckpt, max_files=3)
    assert len(merged_batches(spark, silver)) == 3
    assert _rows(got) == _rows(snapshots.api_to_silver(snapshots.flatten_items(snapshots.read_snapshot_envelopes(spark, landing))))


def test_a_job_killed_after_the_write_counts_once(spark, tmp_path, monkeypatch):
    """The second batch is lost between its overwrite and its record, and again right after its record; a restart of the
    same stream ends with what one batch over all files gives."""
    import pytest

    from trendspark import publish
    from trendspark.streaming import incremental

    landing, silver, ckpt = (str(tmp_path / x) for x in ("landing", "silver", "ckpt"))
    _landed(landing, 6)
    replace = publish.Store.replace
    for after in (False, True):
        def killed(self, name, text, after=after):
            if name.endswith("-1"):
                if after:
                    replace(self, name, text)
                raise RuntimeError("killed")
            replace(self, name, text)

        monkeypatch.setattr(publish.Store, "replace", killed)
        with pytest.raises(Exception, match="killed"):
            run_incremental_silver(spark, landing, silver, ckpt, max_files=2)
        monkeypatch.setattr(publish.Store, "replace", replace)
        assert len(incremental.merged_batches(spark, silver)) == 1 + after
    writes = []
    monkeypatch.setattr(incremental, "write_table", lambda *a, **k: writes.append(a))
    run_incremental_silver(spark, landing, silver + "", ckpt, max_files=4)
    # the recorded batch is left alone; only the third is merged
    assert len(writes) == 1
    monkeypatch.undo()
    got = spark.read.parquet(silver)
    assert got.groupBy(*KEY).count().where("count > 1").count() == 0


def test_a_restart_ends_as_one_batch(spark, tmp_path, monkeypatch):
    import pytest

    from trendspark import publish

    landing, silver, ckpt = (str(tmp_path / x) for x in ("landing", "silver", "ckpt"))
    _landed(landing, 6)
    replace = publish.Store.replace

    def killed(self, name, text):
        raise RuntimeError("killed")

    monkeypatch.setattr(publish.Store, "replace", killed)
    with pytest.raises(Exception, match="killed"):
        run_incremental_silver(spark, landing, silver, ckpt, max_files=2)
    monkeypatch.setattr(publish.Store, "replace", replace)
    got = run_incremental_silver(spark, landing, silver, ckpt, max_files=2)
    assert _rows(got) == _rows(snapshots.api_to_silver(snapshots.flatten_items(snapshots.read_snapshot_envelopes(spark, landing))))
