"""Physical-plan shape: pushdown, pruning, top-N, shuffle budget."""

from pyspark.sql import functions as F

from trendspark.plans.layers import Layers
from trendspark.operators.ranking import top_n
from trendspark.session import cut

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_bridge_reads_every_order_and_prunes_columns(spark):
    plan = _plan(Layers(spark, SF, "orders").raw)
    assert "o_orderdate#" in plan and "LessThan(o_orderdate" not in plan and "GreaterThan(o_orderdate" not in plan
    # lineitem is read with only the five columns the bridge needs
    import re
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    assert [c.split("#")[0] for c in scan.split(",")] == [
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


def test_top_n_uses_window_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        vt = Layers(spark, SF).video_trends
        plan = _plan(top_n(vt, ["region", "snapshot_date"], "views", 5, tie_break=["video_id"]))
        assert "WindowGroupLimit" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_video_trends_shuffle_budget(spark):
    """The ranked rows are written once; then the sums of the rank (two small exchanges) and one exchange for all series
    functions, which share a sort. No source is read again."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(Layers(spark, SF, "orders").video_trends)
        assert plan.count("Exchange hashpartitioning") <= 3 and "FileScan" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_category_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(Layers(spark, SF).enriched)


def test_opportunities_read_the_sources_once(spark):
    """All three scopes, the categories' two uses included, read rows that were written once."""
    assert "FileScan" not in _plan(Layers(spark, SF, "orders").opportunities)


def test_a_cut_leaves_no_shuffle_files(spark):
    def files():
        names = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {n.split("/")[-1] for n in names.split("\n") if "/shuffle_" in n}

    before = files()
    assert cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    left = files() - before  # the count has one small shuffle of its own
    assert len({n.split("_")[1] for n in left}) <= 1
