"""Ranks by prefix sums equal plain window ranks exactly, at any number of parts and in the value's own type."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendspark.operators import ranking

G = ["region", "day"]


@pytest.fixture
def uncoalesced(spark):
    """Small tests keep all their parts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _frame(spark, kind):
    rng = random.Random(5)
    near = [2**53, 2**53 + 1, 2**53 + 2, -(2**62), 2**63 - 1, 0]
    pick = {"bigint": lambda: rng.choice([*near, rng.randrange(40)]), "double": lambda: rng.choice([0.1, -0.0, 0.0, 1e300, rng.random()]),
            "decimal(20,2)": lambda: Decimal(rng.randrange(60)) / 4}[kind]
    rows = [(f"v{i:05d}", "us" if i % 5 else None, "d1", None if i % 11 == 0 else pick()) for i in range(900)]
    hot = pick()
    rows += [(f"w{i:05d}", "us", "d1", hot) for i in range(450)] + [("x", "gb", "d2", pick()), ("y", "fr", "d1", None)]
    return spark.createDataFrame(rows, f"id string, region string, day string, v {kind}").cache()


def _window(df, method, descending):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    w = Window.partitionBy(*G)
    if method == "percent_score":
        return df.withColumn("r", F.round(F.percent_rank().over(w.orderBy(order)).cast("decimal(30,20)") * 100, 2).cast("double"))
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    return df.withColumn("r", fn().over(w.orderBy(order, "id")) if method == "row_number" else fn().over(w.orderBy(order)))


def _values(df):
    return sorted((r.id, r.r) for r in df.select("id", "r").collect())


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,2)"])
@pytest.mark.parametrize("parts", [8, 61])
def test_every_rank_equals_the_window(spark, kind, parts, uncoalesced):
    """A third of the rows share one value, so its run goes over many parts; 61 parts cut small groups too."""
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    df = _frame(spark, kind)
    methods = [("rank", False), ("rank", True), ("dense_rank", False), ("dense_rank", True), ("row_number", True), ("row_number", False)]
    got = ranking.with_ranks(df, G, "v", {f"r{i}": how for i, how in enumerate(methods)}, tie_break=["id"])
    assert got.columns == [*df.columns, *(f"r{i}" for i in range(len(methods)))]
    for i, how in enumerate(methods):
        assert _values(got.select("id", F.col(f"r{i}").alias("r"))) == _values(_window(df, *how)), how


def test_percentiles_equal_the_window(spark, uncoalesced):
    df = _frame(spark, "bigint")
    want = _values(_window(df, "percent_score", False))
    assert _values(ranking.percentile_score(df, G, "v", "r")) == want
    assert _values(ranking.percentile_score_small(df, G, "v", "r")) == want


def test_row_numbers_are_unique_beyond_double_precision(spark):
    df = spark.createDataFrame([("a", "us", "d", 2**53), ("b", "us", "d", 2**53 + 1)], "id string, region string, day string, v bigint")
    got = ranking.rank_within(df, G, "v", "r", "row_number", True, tie_break=["id"])
    assert _values(got) == [("a", 2), ("b", 1)]


def test_numbers_of_an_empty_table_and_of_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 2)], "g string, v int")
    got = sorted((str(r.g), str(r.v), r.i, r.n) for r in ranking.numbered(df, ["g"], ["v"], "i", "n").collect())
    assert got == [("None", "2", 0, 1), ("a", "1", 1, 3), ("a", "1", 2, 3), ("a", "None", 0, 3)]
    assert ranking.numbered(df.limit(0), ["g"], ["v"], "i", "n").collect() == []


def test_a_hot_value_is_dealt_over_many_tasks(spark, uncoalesced):
    """Nine tenths of a group have one value: no part holds more than its share, and the ranks are right."""
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    df = spark.range(20_000).select(F.col("id"), F.lit("us").alias("region"), F.lit("d").alias("day"), F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("v"))
    sizes = [r.n for r in ranking.dealt(df, G, "v", ["id"]).groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 30 and max(sizes) < 3 * 20_000 / 32
    for method, descending in [("rank", True), ("dense_rank", True), ("row_number", True), ("percent_score", False)]:
        assert _values(ranking.rank_within(df, G, "v", "r", method, descending, tie_break=["id"])) == _values(_window(df, method, descending))


def test_three_exchanges_a_rank_and_the_input_planned_once(spark):
    df = spark.createDataFrame([("v", "us", "d", 1)], "id string, region string, day string, v bigint")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
        dealt = plan(ranking.dealt(df, G, "v"))
        ranked = plan(ranking.rank_within(df, G, "v", "r", "rank", True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert dealt.count("Scan ExistingRDD") == 1 and dealt.count("Exchange rangepartitioning") == 1
    assert dealt.count("Exchange ") == 2
    # the rows stay where they are; only the sums, one row for each (part, group), are dealt
    assert ranked.count("Exchange hashpartitioning") == 2 and "+- Exchange" not in ranked.split("Scan ExistingRDD")[0]


def test_written_rows_are_not_dealt_again_for_their_sums(spark, monkeypatch):
    plan = lambda: ranking.rank_within(df, G, "v", "r", "rank", True)._jdf.queryExecution().executedPlan().toString()
    df = _frame(spark, "bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan()
        monkeypatch.setattr(ranking, "SENT", 1)  # more groups than are sent: the same ranks by a dealt join
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert _values(ranking.rank_within(df, G, "v", "r", "rank", True)) == _values(_window(df, "rank", True))
