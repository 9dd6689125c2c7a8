"""Engagement metrics of profiles from their newest posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import ENGAGEMENT_POSTS, MIN_PROFILE_FOLLOWERS
from ..functions.numeric import exact_round, ratio
from .groups import first_n_per_group

NEWEST_POST = ("post_date", "shortcode")


def latest_posts(
    posts: DataFrame, n: int = ENGAGEMENT_POSTS, rank: str | None = None
) -> DataFrame:
    """Newest n posts per profile; the shortcode breaks ties within a day."""
    return first_n_per_group(
        posts, ["handle"], [F.desc("post_date"), F.asc("shortcode")], n, rank
    )


def post_means(posts: DataFrame, n: int = ENGAGEMENT_POSTS) -> DataFrame:
    """Unrounded means over the newest posts of each profile."""
    newest = latest_posts(posts.select("handle", *NEWEST_POST, "likes", "comments", "is_video"), n)
    return newest.groupBy("handle").agg(
        F.avg("likes").alias("mean_likes"),
        F.avg("comments").alias("mean_comments"),
        F.count_if("is_video").alias("reels"),
    )


def post_engagement(
    posts: DataFrame, profiles: DataFrame, min_followers: int = MIN_PROFILE_FOLLOWERS
) -> DataFrame:
    """Social metrics per profile. Profiles without posts or too small give no row."""
    large = profiles.where(F.col("followers") >= min_followers)
    rate = F.when(
        F.col("followers") > 0,
        ratio(F.col("mean_likes") + F.col("mean_comments"), F.col("followers")) * 100,
    ).otherwise(F.lit(0.0))
    measured = post_means(posts).join(large, "handle").withColumn("rate", rate)
    return measured.select(
        F.col("handle").alias("instagram_handle"),
        F.col("followers").alias("instagram_followers"),
        F.col("followees").alias("instagram_following"),
        F.col("mediacount").alias("instagram_posts"),
        exact_round(F.col("mean_likes"), 2).alias("instagram_avg_likes"),
        exact_round(F.col("mean_comments"), 2).alias("instagram_avg_comments"),
        exact_round(F.col("rate"), 2).alias("instagram_engagement_rate"),
        F.col("reels").alias("instagram_reels_count"),
        F.col("is_verified").alias("instagram_verified"),
    )
