import pytest

from trendspark.plans import pipeline
from trendspark.plans.views import register_views

from test_sources import _doc, _item, _land

SF = "/root/testdata/sf0.001"


def _counts(tables):
    return {k: v.count() for k, v in tables.items()}


def test_gold_rerun_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "gold")
    first = _counts(pipeline.run_all(spark, SF, bridge="activity", sink="parquet", out_root=out))
    second = _counts(pipeline.run_all(spark, SF, bridge="activity", sink="parquet", out_root=out))
    assert first == second and all(v > 0 for v in first.values())


def test_run_silver_with_gate(spark, tmp_path):
    landing = str(tmp_path / "landing")
    items = [_item(f"v{i}", 100 + i) for i in range(12)]
    _land(landing, "us", "2026-07-17", 3, _doc(items), "a.json")
    _land(landing, "gb", "2026-07-17", 3, _doc(items, region="gb"), "b.json")
    silver = pipeline.run_silver(spark, landing, str(tmp_path / "silver"), markets=["us"], gate=False)
    assert silver.count() == 12
    observed = pipeline.run_silver(spark, landing, str(tmp_path / "s3"), markets=["us"], observed=True)
    assert observed.count() == 12
    with pytest.raises(RuntimeError, match="rows, at least"):
        _land(str(tmp_path / "few"), "us", "2026-07-17", 3, _doc(items[:3]), "a.json")
        pipeline.run_silver(spark, str(tmp_path / "few"), str(tmp_path / "s4"), observed=True)
    with pytest.raises(RuntimeError):
        pipeline.run_silver(spark, landing, str(tmp_path / "s2"), markets=["fr"], gate=False)


def test_published_views(spark):
    from trendspark.plans.layers import Layers
    views = register_views(Layers(spark, SF))
    assert set(views) == {"v_video_trends", "v_category", "v_channel", "v_opportunities", "v_overview"}
    assert spark.sql("SELECT count(*) AS n FROM v_overview").first().n > 0


def test_run_reference_overwrites_only_present_markets(spark, tmp_path):
    import json
    import os

    def doc(path, items):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            json.dump({"kind": "list", "items": items}, fh)

    bronze, out = tmp_path / "bronze", str(tmp_path / "silver")
    doc(str(bronze / "region=us" / "date=2026-07-17" / "us.json"),
        [{"id": "1", "snippet": {"title": "Film & Animation"}}])
    doc(str(bronze / "region=gb" / "date=2026-07-17" / "gb.json"),
        [{"id": "2", "snippet": {"title": "Autos & Vehicles"}}])
    doc(str(bronze / "region=us" / "date=2026-07-18" / "us.json"),
        [{"id": "1", "snippet": {"title": "Film"}}, {"id": "2", "snippet": {"title": "Autos"}}])
    first = pipeline.run_reference(spark, str(bronze), "2026-07-17", out)
    assert sorted((r.region, r.id) for r in first.collect()) == [("gb", "2"), ("us", "1")]
    second = pipeline.run_reference(spark, str(bronze), "2026-07-18", out)
    assert sorted((r.region, r.id, r.snippet_title) for r in second.collect()) == [
        ("gb", "2", "Autos & Vehicles"), ("us", "1", "Film"), ("us", "2", "Autos")]


def test_landing_writer_round_trip(spark, tmp_path):
    from pyspark.sql import functions as F
    from trendspark.sinks import write_landing
    from trendspark.sources import snapshots
    from trendspark.sources.snapshots import ITEM_SCHEMA

    items = spark.createDataFrame([([{"id": "v1", "statistics": {"viewCount": "5"}}],)],
                                  f"items array<{ITEM_SCHEMA.simpleString()}>")
    env = items.select("items", F.lit("us").alias("region"), F.lit("2026-07-17").alias("date"),
                       F.lit(3).alias("hour"), F.lit("i1").alias("ingestion_id"),
                       F.lit("2026-07-17T03:00:00Z").alias("ingestion_timestamp"))
    base = str(tmp_path / "landing")
    write_landing(env, base)
    back = snapshots.read_snapshot_envelopes(spark, base)
    row = back.first()
    assert row.region == "us" and row._pipeline_metadata.item_count == 1
    assert row._pipeline_metadata.region == "us"
    assert snapshots.flatten_items(back).first().statistics.viewCount == "5"


def test_tune_for_cluster_keeps_explicit_settings(spark):
    from trendspark.session import tune_for_cluster
    before = spark.conf.get("spark.sql.adaptive.enabled")
    applied = tune_for_cluster(spark, target_input_bytes=10 * 1024 ** 4)
    assert "spark.sql.adaptive.enabled" not in applied  # already set by the session
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    assert spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_reports_on_written_gold_match_on_the_fly(spark, tmp_path):
    from trendspark.config import DEFAULT
    from trendspark.plans.layers import Layers
    from trendspark.plans.reports import REPORTS, run_report, run_report_on_gold
    out = str(tmp_path / "gold")
    pipeline.run_all(spark, SF, bridge="activity", sink="parquet", out_root=out, cfg=DEFAULT)
    layers = Layers(spark, SF)
    for name in ("q1_1", "q2_6", "q3_4", "q4_7", "q1_7"):
        a = sorted(map(tuple, run_report(layers, REPORTS[name]).collect()))
        b = sorted(map(tuple, run_report_on_gold(spark, out, REPORTS[name]).collect()))
        assert a == b, name


def test_gold_tables_carry_aggregated_at(spark, tmp_path):
    from trendspark.config import DEFAULT
    from trendspark.operators import quality
    out = str(tmp_path / "gold")
    tables = pipeline.run_all(spark, SF, bridge="activity", sink="parquet", out_root=out, cfg=DEFAULT)
    assert all("_aggregated_at" in df.columns for df in tables.values())
    fresh = quality.run_checks({"trend_opportunities": tables["trend_opportunities"]})
    assert [r for r in fresh["details"] if r["check"] == "freshness"][0].get("latest_record")
