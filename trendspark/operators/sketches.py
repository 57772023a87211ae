"""Stored quantile sketches of view growth: medians over any days without reading a video again.

A quantile is not a sum, so days cannot be added up from their medians. Here each (market, stage, day) keeps one KLL
sketch of its growth rates, a few kilobytes whatever the number of videos, and a question over many days merges the
sketches that it needs. Building is a partial aggregation (sketches are merged map-side before the shuffle), so a stage
with most of the rows is no hot key. A merged quantile lies within RANK_ERROR of the true rank (more than 99 % of the
time; exact while a group has no more than about SKETCH_K values). Rows without a growth rate are not counted; a group
that has none has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.publish import publish, read_table

#: Size parameter of a sketch and the share of ranks by which a quantile of it may be off.
SKETCH_K, RANK_ERROR = 800, 0.01
SKETCH_KEY = ("region", "trend_stage", "snapshot_date")


def growth_sketches(video_trends: DataFrame, key=SKETCH_KEY, value: str = "view_growth_rate", k: int = SKETCH_K) -> DataFrame:
    """One row a group: the key, ``growth_count`` and ``growth_sketch``."""
    known = video_trends.where(F.col(value).isNotNull())
    return known.groupBy(*key).agg(F.count("*").alias("growth_count"),
                                   F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("growth_sketch"))


def merged_quantile(sketches: DataFrame, by=("region", "trend_stage"), q: float = 0.5, name: str = "median_growth",
                    k: int = SKETCH_K) -> DataFrame:
    """The quantile ``q`` of each group of stored sketches: the group, ``growth_count`` and ``name``."""
    merged = sketches.groupBy(*by).agg(F.sum("growth_count").alias("growth_count"),
                                       F.kll_merge_agg_double("growth_sketch", k).alias("_merged"))
    return merged.select(*by, "growth_count", F.kll_sketch_get_quantile_double("_merged", F.lit(q)).alias(name))


def run_sketches(video_trends: DataFrame, root: str) -> DataFrame:
    """Publish the sketches of a trend table, a folder for each day."""
    publish(growth_sketches(video_trends), root, ("snapshot_date",))
    return read_table(video_trends.sparkSession, root)


def median_growth(spark: SparkSession, root: str, days: Column | None = None) -> DataFrame:
    """Median growth by market and stage over the days that ``days`` selects, from the published sketches alone."""
    stored = read_table(spark, root)
    return merged_quantile(stored if days is None else stored.where(days))


def bound_check(video_trends: DataFrame, medians: DataFrame, by=("region", "trend_stage"), value: str = "view_growth_rate") -> DataFrame:
    """Whether each median's rank among all rows lies within RANK_ERROR of one half: the group, ``growth_count`` and
    ``within_bound``."""
    known = video_trends.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    ranks = known.join(medians, [*by]).groupBy(*by).agg(
        F.count("*").alias("growth_count"), F.any_value("growth_count").alias("_stored"),
        F.count_if(F.col("_v") < F.col("median_growth")).alias("_below"), F.count_if(F.col("_v") <= F.col("median_growth")).alias("_up_to"))
    return ranks.select(*by, "growth_count", (
        (F.col("_stored") == F.col("growth_count")) & (F.col("_below") <= (0.5 + RANK_ERROR) * F.col("growth_count"))
        & (F.col("_up_to") >= (0.5 - RANK_ERROR) * F.col("growth_count"))).alias("within_bound"))
