"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    """Schema from ``name TYPE [NOT NULL]`` entries; needs no running session."""
    fields = []
    for column in columns.split(","):
        name, kind, *required = column.split()
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType(fields)


LISTENING = _table("""
    artist_id STRING NOT NULL, artist_name STRING NOT NULL,
    lastfm_listeners BIGINT, lastfm_playcount BIGINT,
    lastfm_playcount_per_listener DOUBLE, lastfm_url STRING,
    genres STRING, primary_genre STRING, source STRING,
    collection_date DATE, collection_timestamp TIMESTAMP
""")

SOCIAL = _table("""
    artist_id STRING, artist_name STRING, instagram_handle STRING,
    instagram_followers BIGINT, instagram_following BIGINT, instagram_posts BIGINT,
    instagram_avg_likes DOUBLE, instagram_avg_comments DOUBLE,
    instagram_engagement_rate DOUBLE, instagram_reels_count BIGINT,
    instagram_verified BOOLEAN
""")

VIDEO = _table("""
    artist_id STRING, artist_name STRING, youtube_channel_id STRING,
    youtube_subscribers BIGINT, youtube_total_views BIGINT,
    youtube_video_count BIGINT, youtube_avg_views_per_video DOUBLE
""")

SONG = _table("""
    artist_name STRING, track_name STRING, lastfm_playcount BIGINT,
    lastfm_listeners BIGINT, lastfm_url STRING, lastfm_rank INT,
    youtube_video_id STRING, youtube_views BIGINT, youtube_likes BIGINT,
    youtube_comments BIGINT, youtube_published_date DATE, youtube_url STRING,
    instagram_post_id STRING, instagram_post_date DATE, instagram_likes BIGINT,
    instagram_comments BIGINT, instagram_url STRING, collection_date DATE
""")

RAW = _table("""
    artist_id STRING NOT NULL, artist_name STRING NOT NULL, collection_date DATE NOT NULL,
    lastfm_url STRING, lastfm_listeners BIGINT, lastfm_playcount BIGINT,
    lastfm_playcount_per_listener DOUBLE, genres STRING, primary_genre STRING,
    instagram_handle STRING, instagram_followers BIGINT, instagram_following BIGINT,
    instagram_posts BIGINT, instagram_avg_likes DOUBLE, instagram_avg_comments DOUBLE,
    instagram_engagement_rate DOUBLE, instagram_reels_count BIGINT,
    instagram_verified BOOLEAN, youtube_channel_id STRING, youtube_subscribers BIGINT,
    youtube_total_views BIGINT, youtube_video_count BIGINT,
    youtube_avg_views_per_video DOUBLE, data_quality_score DOUBLE, last_updated TIMESTAMP
""")

SCORED = _table("""
    artist_id STRING, artist_name STRING, primary_genre STRING, collection_date DATE,
    lastfm_listeners BIGINT, lastfm_playcount BIGINT, lastfm_playcount_per_listener DOUBLE,
    instagram_handle STRING, instagram_followers BIGINT, instagram_engagement_rate DOUBLE,
    instagram_avg_likes DOUBLE, youtube_channel_id STRING, youtube_subscribers BIGINT,
    youtube_total_views BIGINT, underrated_ratio DOUBLE, engagement_score DOUBLE,
    platform_count INT, growth_potential STRING, priority_score DOUBLE,
    follower_gap BIGINT, youtube_avg_views_per_video DOUBLE, data_quality_score DOUBLE
""")

# API payloads, for from_json. Numbers arrive as text and are cast by the parsers; counts
# are maps, which tell an absent count from a null one.
HITS_PAYLOAD = "topartists STRUCT<artist: ARRAY<STRUCT<name: STRING, listeners: STRING>>>"
ARTIST_PAYLOAD = """
    artist STRUCT<name: STRING, url: STRING,
                  stats: MAP<STRING, STRING>,
                  tags: STRUCT<tag: STRING>>
"""
TAG_LIST = "ARRAY<STRUCT<name: STRING>>"
TRACKS_PAYLOAD = """
    toptracks STRUCT<track: ARRAY<STRUCT<name: STRING, playcount: STRING,
        listeners: STRING, url: STRING, `@attr`: STRUCT<rank: STRING>>>>
"""
CHANNELS_PAYLOAD = """
    items ARRAY<STRUCT<id: STRING, snippet: STRUCT<title: STRING, description: STRING>,
        statistics: MAP<STRING, STRING>>>
"""
VIDEOS_PAYLOAD = """
    items ARRAY<STRUCT<id: STRING, snippet: STRUCT<title: STRING, publishedAt: STRING>,
        statistics: MAP<STRING, STRING>>>
"""


def names(schema: T.StructType) -> list[str]:
    return schema.fieldNames()
