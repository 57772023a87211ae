"""Every dashboard report returns its rows in the order that its independent oracle text gives."""

import duckdb
import pytest

from trendspark.oracle.duckdb_sql import with_layers
from trendspark.oracle.reports_sql import REPORTS as WANT
from trendspark.plans.layers import Layers
from trendspark.plans.reports import REPORTS, run_report, run_report_on_gold
from trendspark.plans import pipeline
from trendspark.sources.testdata import TABLES, table_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    pipeline.run_all(spark, SF, bridge="activity", sink="parquet", out_root=root)
    return root


@pytest.mark.parametrize("name", REPORTS)
def test_report_order(spark, con, gold, name):
    want = con.execute(with_layers(WANT[name])).fetchall()
    got = [tuple(r) for r in run_report_on_gold(spark, gold, REPORTS[name]).collect()]
    assert got == want


def test_newest_day_prunes_gold_partitions(spark, gold):
    plan = run_report_on_gold(spark, gold, REPORTS["q2_6"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "scalar-subquery" in plan or "Subquery" in plan


def test_a_market_that_is_gone_leaves_no_partition(spark, tmp_path):
    from trendspark.sinks import GOLD_PARTITIONS, write_table
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("us", "2026-01-01", 1), ("gb", "2026-01-02", 2)], "region string, trending_date_parsed string, n int")
    write_table(both, path, GOLD_PARTITIONS["trending_analytics"], whole=True)
    write_table(both.where("region = 'us'"), path, GOLD_PARTITIONS["trending_analytics"], whole=True)
    assert [r.region for r in spark.read.parquet(path).collect()] == ["us"]
