"""Raw snapshot observations derived from the driver's tables.

The trend model consumes snapshots: one row per (video, market, date) with
cumulative counters. Two bridges turn the driver's Parquet tables into that
shape, both as plain DataFrame plans so their work grows with the tables:

* ``activity``: ``events`` per user, market (from the event id) and UTC day.
  Ten markets, daily snapshots with gaps, zero-view days (error-only days).
* ``orders``: ``lineitem`` joined to its order, the customer's region and the
  part, per part, region and order month. The high-volume bridge.

The output has the raw (pre-Silver) column set of ``operators.silver.CANONICAL``:
text dates in two formats, an upper-case region with padding, counters that
may be NULL, so the Silver cleansing is exercised for real.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.sources.testdata import read_table

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# fixed values: part type -> category id (alphabetical), category id -> name
PART_TYPE_CATEGORY = {
    "ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6,
}
CATEGORY_NAMES = {
    1: "Film & Animation", 2: "Autos & Vehicles", 3: "Music",
    4: "Pets & Animals", 5: "Sports", 6: "Travel & Events",
}


def _finish(df: DataFrame) -> DataFrame:
    """Publish time = first observation of the video anywhere (ISO text)."""
    first = F.min("_first_ts").over(Window.partitionBy("video_id"))
    return df.withColumn("publish_time", F.date_format(first, ISO_INSTANT)).drop("_first_ts")


def activity_snapshots(spark: SparkSession, sf_dir: str,
                       cfg: TrendConfig = DEFAULT) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    markets = F.array(*[F.lit(m) for m in cfg.markets])
    market = F.element_at(markets, (F.col("event_id") % len(cfg.markets) + 1).cast("int"))
    grouped = (
        ev.groupBy(
            F.col("user_id"),
            F.upper(market).alias("_market"),
            F.to_date("ts").alias("_day"),
        )
        .agg(
            F.sum(F.when(F.col("event_type") != "error", F.floor(F.col("value") * 100)))
            .alias("views"),
            F.count_if(F.col("event_type") == "click").alias("likes"),
            F.count_if(F.col("event_type") == "error").alias("dislikes"),
            F.count_if(F.col("event_type") == "purchase").alias("comment_count"),
            F.min("ts").alias("_first_ts"),
        )
    )
    uid = F.col("user_id")
    channel_no = uid % 25
    out = grouped.select(
        F.concat(F.lit("u"), uid.cast("string")).alias("video_id"),
        F.when(uid % 2 == 0, F.date_format("_day", "yy.dd.MM"))
        .otherwise(F.date_format("_day", "yyyy-MM-dd")).alias("trending_date"),
        F.concat(F.lit("Video "), uid.cast("string")).alias("title"),
        F.concat(F.lit("Channel "), channel_no.cast("string")).alias("channel_title"),
        F.when(channel_no % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("UC"), channel_no.cast("string"))).alias("channel_id"),
        (uid % 5 + 1).cast("long").alias("category_id"),
        F.lit(None).cast("string").alias("tags"),
        F.col("views").cast("long").alias("views"),
        F.col("likes").cast("long").alias("likes"),
        F.col("dislikes").cast("long").alias("dislikes"),
        F.col("comment_count").cast("long").alias("comment_count"),
        F.when(uid % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PT"), (uid % 3).cast("string"), F.lit("H"),
                            (uid % 60).cast("string"), F.lit("M"),
                            (uid % 50).cast("string"), F.lit("S"))).alias("duration"),
        F.concat(F.lit(" "), F.col("_market"), F.lit(" ")).alias("region"),
        F.col("_first_ts"),
    )
    return _finish(out)


def orders_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey",
                          "l_quantity", "l_extendedprice", "l_returnflag")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")

    # customer -> region name; nation and region are 25 and 5 rows
    cust_region = (
        customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "r_name")
    )
    order_ctx = orders.join(cust_region, orders.o_custkey == cust_region.c_custkey).select(
        "o_orderkey", "r_name", "o_orderdate",
        F.trunc(F.to_date("o_orderdate"), "month").alias("_month"),
    )
    # aggregate to (part, region, month) before touching the part table
    obs = (
        lineitem.join(order_ctx, lineitem.l_orderkey == order_ctx.o_orderkey)
        .groupBy("l_partkey", "r_name", "_month")
        .agg(
            F.sum(F.floor("l_extendedprice")).alias("views"),
            F.sum(F.col("l_quantity").cast("long")).alias("likes"),
            F.count_if(F.col("l_returnflag") == "R").alias("dislikes"),
            F.count(F.lit(1)).alias("comment_count"),
            F.min("o_orderdate").alias("_first_ts"),
        )
    )
    type_map = F.create_map(*[x for k, v in PART_TYPE_CATEGORY.items()
                              for x in (F.lit(k), F.lit(v))])
    pk = F.col("p_partkey")
    out = obs.join(part, obs.l_partkey == part.p_partkey).select(
        F.concat(F.lit("p"), pk.cast("string")).alias("video_id"),
        F.date_format("_month", "yyyy-MM-dd").alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("channel_title"),
        F.when(pk % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("BR-"), F.col("p_brand"))).alias("channel_id"),
        F.coalesce(F.element_at(type_map, F.col("p_type")), F.lit(0)).cast("long")
        .alias("category_id"),
        F.lit(None).cast("string").alias("tags"),
        F.col("views").cast("long").alias("views"),
        F.col("likes").cast("long").alias("likes"),
        F.col("dislikes").cast("long").alias("dislikes"),
        F.col("comment_count").cast("long").alias("comment_count"),
        F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("duration"),
        F.col("r_name").alias("region"),
        F.col("_first_ts"),
    )
    return _finish(out)


def category_reference(spark: SparkSession, sf_dir: str, bridge: str,
                       cfg: TrendConfig = DEFAULT) -> DataFrame:
    """Category lookup rows (id text, title, market), derived from ``nation``.

    Each nation lists one category for its market: ``orders`` markets are the
    nation's region with category ``nationkey % 6 + 1``; ``activity`` markets
    are ``markets[nationkey % 10]`` with category ``regionkey + 1``. Markets
    therefore miss some categories, which exercises the ``Unknown Category``
    fallback of the lookup. Size is bounded by the nation table (25 rows).
    """
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    names = F.create_map(*[x for k, v in CATEGORY_NAMES.items() for x in (F.lit(k), F.lit(v))])
    if bridge == "orders":
        region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
        pairs = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
            (F.col("n_nationkey") % 6 + 1).cast("long").alias("category_id"),
            F.lower(F.trim("r_name")).alias("region"))
    else:
        markets = F.array(*[F.lit(m) for m in cfg.markets])
        pairs = nation.select(
            (F.col("n_regionkey") + 1).cast("long").alias("category_id"),
            F.element_at(markets, (F.col("n_nationkey") % len(cfg.markets) + 1).cast("int"))
            .alias("region"))
    return pairs.distinct().select(
        F.col("category_id").cast("string").alias("id"),
        F.coalesce(F.element_at(names, F.col("category_id").cast("int")),
                   F.concat(F.lit("Category "), F.col("category_id").cast("string")))
        .alias("snippet_title"),
        F.col("region"),
    )


SNAPSHOT_BRIDGES = {
    "activity": lambda spark, sf_dir, cfg=DEFAULT: activity_snapshots(spark, sf_dir, cfg),
    "orders": lambda spark, sf_dir, cfg=DEFAULT: orders_snapshots(spark, sf_dir),
}
