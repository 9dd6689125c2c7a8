"""Merging the per-source tables into one raw row per artist."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import metrics

SOCIAL_COLUMNS = schemas.names(schemas.SOCIAL)[2:]
VIDEO_COLUMNS = schemas.names(schemas.VIDEO)[2:]

# Columns the load step fills; reels are not among them.
ZERO_INTEGERS = (
    "lastfm_listeners", "lastfm_playcount", "instagram_followers", "instagram_following",
    "instagram_posts", "youtube_subscribers", "youtube_total_views", "youtube_video_count",
)
ZERO_FLOATS = (
    "lastfm_playcount_per_listener", "instagram_avg_likes", "instagram_avg_comments",
    "instagram_engagement_rate", "youtube_avg_views_per_video", "data_quality_score",
)


def stamp_collection(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Add the batch's date and time; every row of a batch gets the same instant.

    A time without a zone is read in the session's zone.
    """
    now = F.lit(at.isoformat(sep=" ")).cast("timestamp") if at else F.current_timestamp()
    return df.withColumns({
        "collection_date": now.cast("date"),
        "collection_timestamp": now,
        "last_updated": now,
    })


def merge_sources(
    listening: DataFrame, social: DataFrame, video: DataFrame, at: dt.datetime | None = None
) -> DataFrame:
    """listening LEFT JOIN social LEFT JOIN video, with completeness and batch stamp.

    All inputs hold one row per artist (see ``latest_per_artist``), so the joins neither
    fan out nor skew; both use the same key and share one partitioning of the artists.
    """
    merged = (
        listening
        .join(social.select("artist_id", *SOCIAL_COLUMNS), "artist_id", "left")
        .join(video.select("artist_id", *VIDEO_COLUMNS), "artist_id", "left")
    )
    merged = merged.withColumn("data_quality_score", metrics.data_quality_score())
    return stamp_collection(merged, at).select(*schemas.names(schemas.RAW))


def zero_fill(raw: DataFrame) -> DataFrame:
    """Replace missing metrics with zeros, as the deployed load step does."""
    fill: dict[str, bool | int | float] = {"instagram_verified": False}
    fill |= dict.fromkeys(ZERO_INTEGERS, 0)
    fill |= dict.fromkeys(ZERO_FLOATS, 0.0)
    return raw.fillna(fill)


def attach_handles(artists: DataFrame, social: DataFrame) -> DataFrame:
    """Artists with their social handle as stored, NULL when there is none."""
    return artists.join(
        social.select("artist_id", "instagram_handle"), "artist_id", "left"
    )
