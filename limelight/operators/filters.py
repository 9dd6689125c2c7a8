"""Row filters. All are plain predicates that reach the scan, or semi/anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..config import (
    CHANNEL_SUBSCRIBERS, EMERGING_LISTENERS, ESTABLISHED_ARTISTS, MIN_PROFILE_FOLLOWERS,
    ScoreConfig, TABLE,
)


def emerging_filter(df: DataFrame, bounds: tuple[int, int] = EMERGING_LISTENERS) -> DataFrame:
    return df.where(F.col("lastfm_listeners").between(*bounds))


def exclude_established(
    df: DataFrame, names: Sequence[str] = ESTABLISHED_ARTISTS
) -> DataFrame:
    """Drop block-listed names, any case; rows without a name stay.

    The list is an argument of the call, so its size is bounded and it may be broadcast.
    """
    if not names:
        return df
    listed = F.array(*[F.lit(n.lower()) for n in names])
    blocked = df.sparkSession.range(1).select(F.explode(listed).alias("blocked"))
    return df.join(
        F.broadcast(blocked), F.lower(df["artist_name"]) == blocked["blocked"], "left_anti"
    )


def scoring_filter(raw: DataFrame, cfg: ScoreConfig = TABLE) -> DataFrame:
    """Rows the scoring rules admit. NULL social metrics pass; NULL listeners do not."""
    followers, rate = F.col("instagram_followers"), F.col("instagram_engagement_rate")
    return raw.where(
        F.col("primary_genre").isin(*cfg.genres)
        & F.col("lastfm_listeners").between(*cfg.listeners)
        & (followers.isNull() | followers.between(*cfg.followers))
        & (rate.isNull() | (rate > cfg.min_engagement_rate))
        & (F.col("data_quality_score") >= cfg.min_quality)
    )


def min_profile_followers(df: DataFrame, minimum: int = MIN_PROFILE_FOLLOWERS) -> DataFrame:
    return df.where(F.col("followers") >= minimum)


def channel_candidates_filter(df: DataFrame) -> DataFrame:
    """Channels worth scoring: not tiny."""
    return df.where(F.col("subscribers") >= CHANNEL_SUBSCRIBERS[0])


def channel_size_filter(df: DataFrame) -> DataFrame:
    """Final channel: neither tiny nor a major label's."""
    return df.where(F.col("subscribers").between(*CHANNEL_SUBSCRIBERS))


def by_growth(df: DataFrame, level: str | None = None) -> DataFrame:
    """One growth class, or everything when no class is chosen."""
    if level is None or level == "All Artists":
        return df
    return df.where(F.col("growth_potential") == level.removesuffix(" Potential"))


def default_genres(df: DataFrame, n: int = 3) -> DataFrame:
    return (
        df.select("primary_genre").where(F.col("primary_genre").isNotNull())
        .distinct().orderBy("primary_genre").limit(n)
    )


def by_genre(df: DataFrame, genres: Sequence[str] | None = None) -> DataFrame:
    """Chosen genres; an empty choice keeps all; no choice means the first three."""
    if genres is None:
        # three rows at most, so the broadcast is bounded
        return df.join(F.broadcast(default_genres(df)), "primary_genre", "left_semi")
    return df.where(F.col("primary_genre").isin(*genres)) if genres else df


def by_follower_range(
    df: DataFrame, minimum: int | None = None, maximum: int | None = None
) -> DataFrame:
    """Followers in range; artists without follower data always stay."""
    followers = F.col("instagram_followers")
    inside = F.lit(True)
    if minimum is not None:
        inside = inside & (followers >= minimum)
    if maximum is not None:
        inside = inside & (followers <= maximum)
    return df.where(followers.isNull() | inside)


def complete_artists(df: DataFrame) -> DataFrame:
    return df.dropna(
        subset=["instagram_followers", "youtube_subscribers", "lastfm_listeners"]
    )


def with_ratio(df: DataFrame) -> DataFrame:
    return df.where(F.col("underrated_ratio").isNotNull())


def by_min_listeners(df: DataFrame, minimum: int = 5_000) -> DataFrame:
    return df.where(F.col("lastfm_listeners") >= minimum)


def by_engagement(df: DataFrame, minimum: float | None = None) -> DataFrame:
    """Optional engagement-rate floor; off by default, and NULL rates then stay."""
    if minimum is None:
        return df
    return df.where(F.col("instagram_engagement_rate") >= minimum)
