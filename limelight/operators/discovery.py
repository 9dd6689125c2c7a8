"""Discovery: union of all searches, first hit per artist."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .groups import first_hit_per_artist


def discover(tag_hits: DataFrame, chart_hits: DataFrame) -> DataFrame:
    """Hits of all tag searches, then of the country chart: the first per artist name."""
    return first_hit_per_artist(tag_hits.unionByName(chart_hits))
