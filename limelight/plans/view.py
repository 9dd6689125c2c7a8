"""The dashboard's filter chain as a small immutable wrapper around a scored table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import distribution, filters
from . import reports


@dataclass(frozen=True)
class ArtistView:
    """Chain filters lazily, then ask for a bounded result."""

    frame: DataFrame

    def by_growth(self, level: str | None) -> ArtistView:
        return ArtistView(filters.by_growth(self.frame, level))

    def by_genre(self, genres: Sequence[str] | None = None) -> ArtistView:
        return ArtistView(filters.by_genre(self.frame, genres))

    def by_followers(self, minimum: int | None = None, maximum: int | None = None) -> ArtistView:
        return ArtistView(filters.by_follower_range(self.frame, minimum, maximum))

    def by_engagement(self, minimum: float | None = None) -> ArtistView:
        return ArtistView(filters.by_engagement(self.frame, minimum))

    def overview(self) -> DataFrame:
        return reports.overview_metrics(self.frame)

    def table(self, n: int = 50) -> DataFrame:
        return reports.display_rows(self.frame, n)

    def genres(self) -> DataFrame:
        """Shown only when there are more than two genres to compare."""
        return reports.genre_counts(self.frame, more_than=2)

    def growth(self) -> DataFrame:
        return reports.growth_summary(self.frame)

    def ratios(self, bins: int = 20) -> DataFrame:
        return distribution.histogram(self.frame, "underrated_ratio", bins)

    def comparison(self, artist_name: str) -> DataFrame:
        """One artist's platforms, relative to the maxima of the filtered artists."""
        return distribution.platform_normalised(self.frame).where(
            F.col("artist_name") == artist_name
        )

    def default_artist(self) -> DataFrame:
        return reports.default_artist(self.frame)

    def detail(self, artist_name: str) -> DataFrame:
        return reports.artist_detail(self.frame, artist_name)
