"""The scoring query."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas
from ..config import ScoreConfig, TABLE
from ..functions import metrics
from ..operators.filters import scoring_filter
from ..operators.groups import score_order
from ..operators.merge import zero_fill


def score(raw: DataFrame, cfg: ScoreConfig = TABLE) -> DataFrame:
    """Admit, score and classify artists: one narrow pass over the raw table, unordered."""
    return scoring_filter(raw, cfg).withColumns({
        "underrated_ratio": metrics.underrated_ratio(),
        "engagement_score": metrics.engagement_score(),
        "platform_count": metrics.platform_count(),
        "growth_potential": metrics.growth_potential(cfg),
        "priority_score": metrics.priority_score(),
        "follower_gap": metrics.follower_gap(),
    }).select(*schemas.names(schemas.SCORED))


def scored_artists(raw: DataFrame, cfg: ScoreConfig = TABLE) -> DataFrame:
    """The full scoring query, best first."""
    return score(raw, cfg).orderBy(*score_order())


def score_zero_filled(raw: DataFrame, cfg: ScoreConfig = TABLE) -> DataFrame:
    """Scores as deployed: the load step zero-fills, so artists lacking social data drop."""
    return scored_artists(zero_fill(raw), cfg)
