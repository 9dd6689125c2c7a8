"""Per-artist metric expressions: listening, scoring, completeness, labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import TAGS_KEPT, ScoreConfig, TABLE
from .numeric import exact_round, grouped, ratio


def artist_id(query_name: Column) -> Column:
    return F.md5(F.encode(query_name, "UTF-8"))


def plays_per_listener(playcount: Column, listeners: Column) -> Column:
    return F.when(
        listeners > 0, exact_round(ratio(playcount, listeners), 2)
    ).otherwise(F.lit(0.0))


def genre_tags(tag_names: Column) -> Column:
    """First five tag names; a missing list counts as empty."""
    empty = F.array().cast("array<string>")
    return F.slice(F.coalesce(tag_names, empty), 1, TAGS_KEPT)


def primary_genre(tags: Column) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit("unknown"))


def underrated_ratio() -> Column:
    return ratio(F.col("instagram_followers"), F.col("lastfm_listeners"))


def engagement_score() -> Column:
    # Spark's least() skips NULLs; the score must stay NULL when the rate is.
    rate = F.col("instagram_engagement_rate")
    return F.when(rate.isNotNull(), F.least(rate * 2, F.lit(10.0)))


def platform_count() -> Column:
    def present(name: str, floor: int) -> Column:
        return F.when(F.col(name) > floor, 1).otherwise(0)

    return (
        present("lastfm_listeners", 5_000)
        + present("instagram_followers", 10_000)
        + present("youtube_subscribers", 1_000)
    )


def growth_potential(cfg: ScoreConfig = TABLE) -> Column:
    followers, listeners = F.col("instagram_followers"), F.col("lastfm_listeners")
    return (
        F.when(followers > listeners * F.lit(cfg.high_multiple), "High")
        .when(followers > listeners * F.lit(cfg.medium_multiple), "Medium")
        .otherwise("Low")
    )


def priority_score() -> Column:
    # The order of the additions is part of the result; NULL in any term gives NULL.
    followers = F.col("instagram_followers")
    weighted = (
        followers * F.lit(0.3)
        + F.col("instagram_engagement_rate") * followers * F.lit(0.4)
        + F.col("youtube_subscribers") * F.lit(0.2)
        + F.col("lastfm_playcount_per_listener") * F.lit(1000.0) * F.lit(0.1)
    )
    listeners = F.col("lastfm_listeners")
    return ratio(weighted, F.when(listeners.isNotNull(), F.greatest(listeners, F.lit(1))))


def follower_gap() -> Column:
    return F.col("instagram_followers") - F.col("lastfm_listeners")


def data_quality_score() -> Column:
    def has(name: str) -> Column:
        return F.col(name).isNotNull().cast("int")

    return (
        has("lastfm_listeners") * F.lit(0.3)
        + has("instagram_followers") * F.lit(0.4)
        + has("youtube_subscribers") * F.lit(0.3)
    )


def channel_avg_views(views: Column, videos: Column) -> Column:
    return F.when(videos > 0, F.rint(ratio(views, videos))).otherwise(F.lit(0.0))


def engagement_label(rate: Column) -> Column:
    def text(digits: int) -> Column:
        return F.format_string(f"%.{digits}f%%", exact_round(rate, digits))

    return (
        F.when(rate.isNull(), F.lit("N/A"))
        .when(rate < 1, text(3))
        .when(rate < 10, text(2))
        .otherwise(text(1))
    )


def artist_label() -> Column:
    return F.concat(
        F.col("artist_name"), F.lit(" ("), grouped(F.col("lastfm_listeners")),
        F.lit(" Last.fm Listeners)"),
    )


def social_label() -> Column:
    return F.when(
        F.col("instagram_handle").isNotNull(),
        F.concat(
            F.lit("@"), F.col("instagram_handle"), F.lit(" ("),
            grouped(F.col("instagram_followers")), F.lit(" Followers)"),
        ),
    ).otherwise("N/A")


def ratio_side(value: Column) -> Column:
    return F.when(value > 1, "above").when(value < 1, "below").when(value == 1, "equal")
