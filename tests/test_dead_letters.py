"""Damaged landed documents are reported with their path, in batch and in the stream; good plus dead is landed."""

import json

import pytest

from trendspark.sources import dead_letters
from trendspark.streaming import incremental

GOOD = {"items": [{"id": "vid-one", "snippet": {"title": "T", "channelTitle": "C", "categoryId": "7"}, "statistics": {"viewCount": "12", "likeCount": "3"}}],
        "_pipeline_metadata": {"ingestion_id": "a", "region": "se", "ingestion_timestamp": "2026-02-01T03:00:00", "source": "api", "item_count": 1}}


@pytest.fixture
def landing(tmp_path):
    base = tmp_path / "landing"
    texts = {
        "good.json": json.dumps(GOOD, indent=1), "two.json": json.dumps({**GOOD, "items": [{"id": "vid-two"}, {"id": "vid-three"}]}),
        "empty_items.json": json.dumps({"items": []}), "truncated.json": json.dumps(GOOD)[:70], "page.json": "<html>Too many requests</html>",
        "none.json": json.dumps({"error": {"code": 403}}), "other.json": json.dumps({"items": "x"}),
    }
    for i, (name, text) in enumerate(texts.items()):
        folder = base / f"region={'se' if i % 2 else 'pl'}" / "date=2026-02-01" / "hour=03"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)
    return str(base)


def names(df):
    return sorted((r.path.rsplit("/", 1)[1], r.reason) for r in df.collect())


WANT = [("none.json", "no items"), ("other.json", "unparsable"), ("page.json", "unparsable"), ("truncated.json", "unparsable")]


def test_good_and_dead_are_all_that_landed(spark, landing):
    landed = dead_letters.read_landed(spark, landing)
    good, dead = dead_letters.split(landed)
    assert names(dead) == WANT and good.count() + dead.count() == landed.count() == 7
    assert dead_letters.account(landed).first().asDict() == {"landed": 7, "good": 3, "dead": 4, "unparsable": 3, "no_items": 1}
    texts = {r.path.rsplit("/", 1)[1]: r.text for r in dead.collect()}
    assert texts["page.json"].startswith("<html>") and texts["truncated.json"].startswith('{"items"') and texts["none.json"] is None
    assert dead.columns == list(dead_letters.DEAD)
    rows = dead_letters.split(dead_letters.read_landed(spark, landing, markets=["se"]))
    assert {r.region for f in rows for r in f.select("region").collect()} == {"se"}


def test_a_batch_run_again_replaces_its_own_letters(spark, landing, tmp_path):
    out = str(tmp_path / "dead")
    _, dead = dead_letters.split(dead_letters.read_landed(spark, landing))
    for _ in range(2):
        dead_letters.write_dead_letters(dead, out, "7")
    dead_letters.write_dead_letters(dead.limit(1), out, "8")
    assert dead_letters.read_dead_letters(spark, out).count() == 5


def test_the_stream_reports_them_too(spark, landing, tmp_path):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "dead")
    rows = incremental.run_incremental_silver(spark, landing, silver, str(tmp_path / "ckpt"), dead_letters_path=out)
    assert {r.video_id for r in rows.select("video_id").collect()} == {"vid-one", "vid-two", "vid-three"}
    assert names(dead_letters.read_dead_letters(spark, out)) == WANT
    # a second run over the same landing adds nothing
    incremental.run_incremental_silver(spark, landing, silver, str(tmp_path / "ckpt"), dead_letters_path=out)
    assert names(dead_letters.read_dead_letters(spark, out)) == WANT
