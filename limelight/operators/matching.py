"""Resolving social profiles and video channels from text and name evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import HANDLE_VIDEOS, MIN_CHANNEL_MATCH, MIN_PROFILE_FOLLOWERS, SEARCH_RESULTS
from ..functions import text
from ..session import stored_once
from .filters import channel_candidates_filter
from .groups import first_n_per_group, lookup_join, spread_nulls
from .videos import recent_videos


def verify_handles(
    candidates: DataFrame, profiles: DataFrame, min_followers: int = MIN_PROFILE_FOLLOWERS
) -> DataFrame:
    """Candidates whose profile exists, is large enough and fits the artist.

    Profiles are unique by handle, so a handle that a third of all texts mention only
    skews the candidate side.
    """
    large = profiles.where(F.col("followers") >= min_followers).select(
        "handle", "full_name", "biography"
    )
    return (
        lookup_join(candidates, large, "handle", "handle")
        .where(text.profile_matches(F.col("artist_name"), F.col("full_name"), F.col("biography")))
        .drop("full_name", "biography")
    )


def existing_profiles(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """Candidates whose handle exists at all."""
    return lookup_join(candidates, profiles.select("handle"), "handle", "handle", "left_semi")


def found_channels(
    search: DataFrame, channels: DataFrame, results: int | None = SEARCH_RESULTS
) -> DataFrame:
    """Search results with channel statistics.

    The collection step asks for ten ``results`` a search, the default here; None takes
    every landed one.
    """
    if results is not None:
        search = search.where(F.col("search_rank") <= results)
    return lookup_join(search, channels, "channel_id", "channel_id")


def artist_channel_candidates(
    artists: DataFrame, search: DataFrame, channels: DataFrame,
    results: int | None = SEARCH_RESULTS,
) -> DataFrame:
    """Every searched channel of every artist with its match score."""
    found = channel_candidates_filter(found_channels(search, channels, results))
    named = artists.select(
        "artist_id", "artist_name", text.channel_name_words(F.col("artist_name")).alias("_words")
    )
    return found.join(named, "artist_id").withColumn(
        "match_score",
        text.channel_match_score(
            F.col("_words"), F.col("title"), F.col("description"), F.col("subscribers")
        ),
    ).drop("_words")


def best_channel(candidates: DataFrame, minimum: int = MIN_CHANNEL_MATCH) -> DataFrame:
    """Highest (match score, subscribers) per artist, if the score is high enough.

    Earlier search results win ties.
    """
    return first_n_per_group(
        candidates,
        ["artist_id"],
        [F.desc("match_score"), F.desc("subscribers"), F.asc("search_rank"), F.asc("channel_id")],
        1,
    ).where(F.col("match_score") >= minimum)


def largest_channel(search: DataFrame, channels: DataFrame) -> DataFrame:
    """Most subscribed searched channel per artist; earlier search results win ties."""
    return first_n_per_group(
        found_channels(search, channels),
        ["artist_id"],
        [F.desc("subscribers"), F.asc("search_rank"), F.asc("channel_id")],
        1,
    )


def handle_candidates(
    artists: DataFrame, search: DataFrame, channels: DataFrame, videos: DataFrame,
    newest: int = HANDLE_VIDEOS,
) -> DataFrame:
    """All handles to try per artist, numbered in the order they are tried.

    The channel's own text comes first, then its ``newest`` videos (the collection step
    reads five, the default), then guesses made from the name. Each artist carries its few
    texts in one row, so every input is read and shuffled once. The chosen channels are
    stored, and only their texts go on from the ranking of the videos.
    """
    channel = stored_once(largest_channel(
        search, channels.select("channel_id", "description", "subscribers")
    ).select("artist_id", "channel_id", "description"), "channels")
    chosen = channel.select("channel_id").distinct()
    # at most `newest` texts per channel
    video_texts = recent_videos(
        videos.select("channel_id", "video_id", "published_at", "description"),
        newest, rank="source_ord",
    ).join(chosen, "channel_id", "left_semi").groupBy("channel_id").agg(
        F.collect_list(F.struct("source_ord", "description")).alias("texts")
    )

    def source(source_ord: Column, handles: Column) -> Column:
        return F.struct(source_ord.alias("source_ord"), handles.alias("handles"))

    name_source = F.lit(newest + 1)
    from_channel = F.array(source(F.lit(0), text.extract_handles(F.col("description"))))
    from_videos = F.transform(
        "texts", lambda t: source(t["source_ord"], text.extract_handles(t["description"]))
    )
    from_name = F.array(source(name_source, text.name_handle_variants(F.col("artist_name"))))
    with_channel = (
        artists.select("artist_id", "artist_name")
        .join(channel, "artist_id", "left")
        .withColumn("channel_id", spread_nulls(F.col("channel_id"), F.col("artist_id")))
    )
    return (
        lookup_join(with_channel, video_texts, "channel_id", "channel_id", "left")
        .select(
            "artist_id", "artist_name",
            F.inline(F.concat(
                from_channel,
                F.when(F.col("texts").isNotNull(), from_videos)
                .otherwise(F.slice(from_name, 1, 0)),
                from_name,
            )),
        )
        .select(
            "artist_id", "artist_name", "source_ord",
            F.posexplode("handles").alias("position", "handle"),
        )
    )


def resolve_handle(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """First verified handle per artist."""
    verified = verify_handles(candidates, profiles)
    return first_n_per_group(
        verified, ["artist_id"],
        [F.asc("source_ord"), F.asc("position"), F.asc("handle")], 1,
    ).select("artist_id", "artist_name", "handle", "source_ord")
