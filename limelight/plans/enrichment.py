"""End-to-end compositions: from landed payloads and tables to source rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators import filters, matching, merge, posts as post_ops, songs, videos as video_ops
from ..operators.discovery import discover
from ..operators.groups import append_batch, lookup_join, only_wanted
from ..session import stored_once
from ..sources import payloads
from ..sources.tables import empty_source


def discover_artists(
    tag_payloads: DataFrame, chart_payloads: DataFrame, info_payloads: DataFrame,
    existing: DataFrame | None = None, at: dt.datetime | None = None,
) -> DataFrame:
    """Listening rows of emerging artists, folded into the stored ones.

    ``info_payloads`` holds (query_name, body) for the discovered names.
    """
    hits = discover(
        payloads.parse_tag_hits(tag_payloads), payloads.parse_geo_hits(chart_payloads)
    ).select(F.col("artist_name").alias("query_name"), "source")
    details = payloads.parse_artist_info(
        info_payloads.select("query_name", "body").join(hits, "query_name")
    )
    fresh = merge.stamp_collection(
        filters.exclude_established(filters.emerging_filter(details)), at
    ).select(*schemas.names(schemas.LISTENING))
    if existing is None:
        existing = empty_source(fresh.sparkSession, schemas.LISTENING)
    return append_batch(existing, fresh, ["artist_id"], ["collection_timestamp"])


def social_profiles(
    artists: DataFrame, search: DataFrame, channels: DataFrame, videos: DataFrame,
    profiles: DataFrame, posts: DataFrame,
) -> DataFrame:
    """SOCIAL rows: resolve each artist's handle, then measure the profile.

    The resolved handles are stored, and only their posts are ranked.
    """
    candidates = matching.handle_candidates(artists, search, channels, videos)
    resolved = stored_once(matching.resolve_handle(candidates, profiles).select(
        "artist_id", "artist_name", F.col("handle").alias("instagram_handle")
    ), "resolved")
    measured = post_ops.post_engagement(
        only_wanted(posts, resolved, "handle", "instagram_handle"), profiles
    )
    return lookup_join(
        resolved, measured, "instagram_handle", "instagram_handle"
    ).select(*schemas.names(schemas.SOCIAL))


def video_channels(
    artists: DataFrame, search: DataFrame, channels: DataFrame, videos: DataFrame
) -> DataFrame:
    """VIDEO rows: best matching channel, its statistics and recent mean views.

    The chosen channels are stored, and only their videos are ranked.
    """
    best = matching.best_channel(
        matching.artist_channel_candidates(artists, search, channels)
    )
    stats = stored_once(video_ops.channel_stats(best, "artist_id", "artist_name"), "chosen")
    wanted = only_wanted(videos, stats, "channel_id", "youtube_channel_id")
    return video_ops.with_recent_mean(stats, wanted).select(*schemas.names(schemas.VIDEO))


def song_catalogue(
    artists: DataFrame, social: DataFrame, tracks: DataFrame, search: DataFrame,
    videos: DataFrame, posts: DataFrame, on: dt.date | None = None,
) -> DataFrame:
    """SONG rows for the top tracks of every artist."""
    named = merge.attach_handles(artists.select("artist_id", "artist_name"), social)
    wanted = songs.top_tracks(tracks).join(named, "artist_id")
    return songs.song_records(wanted, search, videos, posts, on)
