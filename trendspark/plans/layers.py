"""The layer graph, built lazily: raw -> Silver -> Gold -> trends -> opportunities.

``Layers`` only composes DataFrame plans; nothing runs until an action. Query
callables take the frame they need, so Catalyst prunes everything else
(a report on ``trending_analytics`` never plans the video windows).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.operators import gold, opportunities, silver, trends
from trendspark.session import checkpoint_dir, cut, prepare
from trendspark.sources.bridges import SNAPSHOT_BRIDGES, category_reference

FIXED_AS_OF = "2026-01-01 00:00:00"


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, bridge: str = "activity",
                 cfg: TrendConfig = DEFAULT, as_of: Column | None = None):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.bridge = bridge
        self.cfg = cfg
        self.as_of = as_of if as_of is not None else F.lit(FIXED_AS_OF).cast("timestamp")

    @cached_property
    def raw(self) -> DataFrame:
        return SNAPSHOT_BRIDGES[self.bridge](self.spark, self.sf_dir, self.cfg)

    @cached_property
    def silver(self) -> DataFrame:
        # bridge rows are unique per (video, market, date) by construction, so
        # the de-duplication shuffle is skipped here (it runs on landed data)
        return silver.build_silver(self.raw, job_name=f"bridge_{self.bridge}",
                                   processed_at=self.as_of, dedup=False)

    @cached_property
    def newest_day(self) -> DataFrame:
        """One row, ``day``: the newest snapshot of Silver, and so of every Gold table."""
        return self.silver.agg(F.max("trending_date_parsed").alias("day"))

    @cached_property
    def reference(self) -> DataFrame:
        return category_reference(self.spark, self.sf_dir, self.bridge, self.cfg)

    @cached_property
    def enriched(self) -> DataFrame:
        return gold.add_category_name(self.silver, self.reference)

    @cached_property
    def written(self) -> DataFrame:
        """What the channel, category and video tables read of ``enriched``, written once: each of them reads it several
        times, and its joins are not done again."""
        return cut(self.enriched.select(*trends.PUBLISHED, trends.DATE, "engagement_rate"))

    @cached_property
    def trending(self) -> DataFrame:
        return gold.build_trending_analytics(self.enriched)

    @cached_property
    def channel(self) -> DataFrame:
        return gold.build_channel_analytics(self.written, self.cfg)

    @cached_property
    def category(self) -> DataFrame:
        return gold.build_category_analytics(self.__dict__.get("written", self.enriched), self.cfg)

    @cached_property
    def video_trends(self) -> DataFrame:
        written = self.__dict__.get("written")
        if written is None:
            written = cut(self.enriched.select(*trends.PUBLISHED, trends.DATE))
        return trends.compute_video_trends(written, self.cfg)

    @cached_property
    def cross_market(self) -> DataFrame:
        return trends.compute_cross_market(self.category, self.cfg)

    @cached_property
    def opportunities(self) -> DataFrame:
        if "category" not in self.__dict__:
            self.written  # noqa: B018 - so that the categories read it too
        return opportunities.build_trend_opportunities(
            self.video_trends, self.category, self.cross_market, self.channel, self.cfg)

    def shared(self) -> "Layers":
        """These layers with Silver and the Gold tables that others build on written once (reliable checkpoints), for
        queries that read several of them."""
        if "enriched" not in self.__dict__:
            checkpoint_dir(self.spark)
            self.silver = self.silver.checkpoint()
            self.enriched = self.written = self.enriched.checkpoint()
            for name in ("category", "channel", "video_trends", "opportunities"):
                setattr(self, name, getattr(self, name).checkpoint())
        return self

    def gold_tables(self) -> dict[str, DataFrame]:
        return {
            "trending_analytics": self.trending,
            "channel_analytics": self.channel,
            "category_analytics": self.category,
            "video_trends": self.video_trends,
            "trend_opportunities": self.opportunities,
        }
