"""The exact HALF_UP division equals decimal arithmetic over the whole long range."""

import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

from pyspark.sql import functions as F

from trendspark.functions.columns import growth, ratio, scaled, weighted_score
from trendspark.operators import quality, silver

LOW, HIGH = -(2**63), 2**63 - 1


def _exact(n, d, places):
    getcontext().prec = 60
    return float((Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def _close(a, b):
    return a == b or abs(a - b) <= 1e-15 * abs(b)


def _rows():
    rng = random.Random(7)
    rows = [(rng.randint(-10**9, 10**9), rng.choice((-1, 1)) * rng.randint(1, 10**6)) for _ in range(1500)]
    rows += [(rng.randint(LOW, HIGH), rng.choice((rng.randint(LOW + 1, HIGH), 1, -3, 7)) or 1) for _ in range(1500)]
    return rows + [(1, 8), (-1, 8), (5, 10), (-5, 10), (0, 3), (125, 100000), (-125, 100000), (HIGH, 1), (LOW, 1), (HIGH, HIGH), (6, -4), (1, -8)]


def test_scaled_matches_decimal_half_up(spark):
    df = spark.createDataFrame(_rows(), "n bigint, d bigint")
    for places in (0, 1, 2, 4, 6):
        for r in df.select("n", "d", F.expr(scaled("n", "d", places)).alias("r"), F.expr(scaled("n", "d", places, times=100)).alias("p")).collect():
            assert _close(r.r, _exact(r.n, r.d, places)), (r.n, r.d, places)
            assert _close(r.p, _exact(r.n * 100, r.d, places)), (r.n, r.d, places)


def test_growth_with_negative_and_extreme_baselines(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "cur bigint, prev bigint")
    for places in (0, 2, 6):
        for r in df.select("cur", "prev", growth("cur", "prev", places).alias("g")).collect():
            assert _close(r.g, _exact(r.cur - r.prev, r.prev, places)), (r.cur, r.prev, places)
    odd = spark.createDataFrame([(6, -4), (5, 0), (5, None), (None, 5)], "cur bigint, prev bigint")
    assert [r.g for r in odd.select(growth("cur", "prev", 0).alias("g")).collect()] == [-3.0, None, None, None]


def test_sums_beyond_the_long_range(spark):
    df = spark.createDataFrame([(HIGH, HIGH, HIGH, HIGH), (2, 3, 4, 8)], "a bigint, b bigint, c bigint, v bigint")
    assert [r.r for r in df.select(ratio(("a", "b", "c"), "v", 4, times=100).alias("r")).collect()] == [300.0, 112.5]


def test_silver_finishes_on_extreme_counters_and_the_gate_reports_them(spark):
    rows = [(f"v{i}", "2026-07-17", "t", "c", "us", HIGH, HIGH, HIGH, HIGH, "2020-01-01T00:00:00Z") for i in range(12)]
    rows += [(f"w{i}", "2026-07-17", "t", "c", "us", 5, 2 * 10**13, 0, LOW + 1, None) for i in range(3)]
    raw = spark.createDataFrame(rows, "video_id string, trending_date string, title string, channel_title string, region string, "
                                      "views bigint, likes bigint, dislikes bigint, comment_count bigint, publish_time string")
    out = silver.build_silver(raw)
    assert out.where("views > 5").select("like_rate", "engagement_rate").distinct().collect() == [(1.0, 300.0)]
    check = [r for r in quality.check_table(out, "clean_statistics") if r["check"] == "value_range"][0]
    assert check["extreme_count"] == 12 and not check["passed"]


def test_weighted_score_is_exact_half_up(spark):
    rows = [(12.34, 56.78, 90.12), (0.01, 0.02, 0.03), (99.99, 0.0, 50.0), (33.33, 66.67, 14.29)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = [r.s for r in df.select(weighted_score(
        [(F.col("a"), 5), (F.col("b"), 3), (F.col("c"), 2)], 10).alias("s")).collect()]
    want = [float((Decimal(str(a)) * Decimal("0.5") + Decimal(str(b)) * Decimal("0.3")
                   + Decimal(str(c)) * Decimal("0.2")).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
            for a, b, c in rows]
    assert got == want
