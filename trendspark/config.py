"""Tunable parameters of the trend model, in one frozen dataclass.

Every operator takes a ``TrendConfig`` (default ``DEFAULT``) instead of reading
module globals, so a test or a job can change a threshold without patching.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# --- fixed values (must equal the modelled pipeline for equal results) -------
# Stage rules: EMERGING within the first 3 trending days at > 20 % growth,
# FADING below -5 %, ESTABLISHED after more than 7 days of flat growth;
# persistence saturates at 7 days; market expansion is out of 10 markets.
# Score weights: video 0.5 velocity / 0.3 engagement / 0.2 persistence;
# category 0.4 velocity / 0.25 engagement / 0.35 market expansion;
# channel 0.7 views percentile / 0.3 trending frequency.
# Top-N per market and date: 20 videos, 10 categories, 10 channels.
# Reach classes: >= 7 markets GLOBAL, >= 2 REGIONAL, else LOCAL.
# Markets: us, gb, in, ca, au, de, fr, jp, kr, ru.
# Quality gate: min 10 rows, max 5.0 % nulls, max 50,000,000,000 views,
# freshness 48 hours.
MARKETS = ("us", "gb", "in", "ca", "au", "de", "fr", "jp", "kr", "ru")


@dataclass(frozen=True)
class TrendConfig:
    emerging_max_days: int = 3
    emerging_growth_threshold: float = 0.20
    fading_growth_threshold: float = -0.05
    established_min_days: int = 7
    persistence_cap_days: int = 7
    total_markets: int = 10

    # weights in tenths (video, channel) or twentieths (category) so that
    # composite scores can be computed in exact integer hundredths
    video_weights: tuple[int, int, int] = (5, 3, 2)  # /10
    category_weights: tuple[int, int, int] = (8, 5, 7)  # /20
    channel_weights: tuple[int, int] = (7, 3)  # /10

    top_videos: int = 20
    top_categories: int = 10
    top_channels: int = 10

    momentum_snapshots: int = 3
    global_min_markets: int = 7
    regional_min_markets: int = 2

    markets: tuple[str, ...] = field(default=MARKETS)

    dq_min_rows: int = 10
    dq_max_null_pct: float = 5.0
    dq_max_views: int = 50_000_000_000
    dq_freshness_hours: int = 48

    # category evidence used to multiply an already-percent rate by 100 again;
    # True reproduces that text, False prints the rate as a percent once
    legacy_evidence: bool = False


DEFAULT = TrendConfig()
