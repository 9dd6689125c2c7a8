"""Channel statistics and recent-video averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import RECENT_VIDEOS
from ..functions.metrics import channel_avg_views
from .filters import channel_size_filter
from .groups import first_n_per_group, lookup_join


def recent_videos(videos: DataFrame, n: int = RECENT_VIDEOS, rank: str | None = None) -> DataFrame:
    """Newest n videos per channel."""
    return first_n_per_group(
        videos, ["channel_id"], [F.desc("published_at"), F.asc("video_id")], n, rank
    )


def recent_video_mean(videos: DataFrame, n: int = RECENT_VIDEOS) -> DataFrame:
    """Mean views of each channel's newest videos, rounded to a whole number."""
    newest = recent_videos(videos.select("channel_id", "video_id", "published_at", "views"), n)
    return newest.groupBy("channel_id").agg(F.rint(F.avg("views")).alias("recent_mean_views"))


def channel_stats(channels: DataFrame, *keep: str) -> DataFrame:
    """Channels of acceptable size with their lifetime views per video."""
    return channel_size_filter(channels).select(
        *keep, F.col("channel_id").alias("youtube_channel_id"),
        F.col("subscribers").alias("youtube_subscribers"),
        F.col("views").alias("youtube_total_views"),
        F.col("videos").alias("youtube_video_count"),
        channel_avg_views(F.col("views"), F.col("videos")).alias("youtube_avg_views_per_video"),
    )


def with_recent_mean(stats: DataFrame, videos: DataFrame) -> DataFrame:
    """Replace lifetime views per video by the recent mean; 0 when there are no videos."""
    means = recent_video_mean(videos)
    return lookup_join(stats, means, "youtube_channel_id", "channel_id", "left").withColumn(
        "youtube_avg_views_per_video", F.coalesce("recent_mean_views", F.lit(0.0))
    ).drop("recent_mean_views")
