"""Song rows: chart tracks with their video and the post that announced them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from .. import schemas
from ..config import RELEASE_POSTS, RELEASE_WINDOW_DAYS, TOP_TRACKS
from ..functions import text
from ..session import stored_once
from .groups import first_n_per_group, lookup_join, only_wanted, spread_nulls
from .posts import latest_posts

POST_FIELDS = (
    "instagram_post_rank", "instagram_post_id", "instagram_post_date", "instagram_likes",
    "instagram_comments", "instagram_caption", "instagram_url",
)


def top_tracks(tracks: DataFrame, n: int = TOP_TRACKS) -> DataFrame:
    """The n best-ranked tracks of each artist."""
    return first_n_per_group(
        tracks, ["artist_id"], [F.asc("lastfm_rank"), F.asc("track_id")], n
    )


def track_video(tracks: DataFrame, search: DataFrame, videos: DataFrame) -> DataFrame:
    """Each track with its single most relevant video, NULL when none is known.

    The search results are cut to one per track and stored before the video table is joined,
    so that only videos found are moved, and the texts that follow from a video's id are
    made after that.
    """
    top = stored_once(first_n_per_group(
        search, ["track_id"], [F.asc("search_rank"), F.asc("video_id")], 1
    ).select("track_id", "video_id"), "top-videos")
    details = only_wanted(videos, top, "video_id", "video_id").select(
        "video_id",
        F.col("title").alias("youtube_video_title"),
        F.col("views").alias("youtube_views"),
        F.col("likes").alias("youtube_likes"),
        F.col("comments").alias("youtube_comments"),
        text.published_date(F.col("published_at")).alias("youtube_published_date"),
    )
    # neither side is grouped by the video yet, so a plain join shuffles both as they are
    found = top.join(details, "video_id").withColumnRenamed("video_id", "youtube_video_id")
    return tracks.join(found, "track_id", "left").withColumn(
        "youtube_url", text.video_url(F.col("youtube_video_id"))
    )


def post_projection(posts: DataFrame) -> DataFrame:
    """Posts as they appear in song rows: shortened caption and a link."""
    return posts.select(
        "handle",
        F.col("shortcode").alias("instagram_post_id"),
        F.col("post_date").alias("instagram_post_date"),
        F.col("likes").alias("instagram_likes"),
        F.col("comments").alias("instagram_comments"),
        text.caption_excerpt(F.col("caption")).alias("instagram_caption"),
        text.post_url(F.col("shortcode")).alias("instagram_url"),
    )


def _near_releases(ranked: DataFrame, tracks: DataFrame, window_days: int) -> DataFrame:
    """Ranked posts that lie near a release of their handle; every track has a date.

    Both sides lie by handle already, and a handle's days are bounded by the calendar.
    """
    days = tracks.where(F.col("instagram_handle").isNotNull()).groupBy(
        F.col("instagram_handle").alias("handle")
    ).agg(F.collect_set("release_date").alias("_days"))
    near = F.exists("_days", lambda d: F.abs(F.datediff("post_date", d)) <= window_days)
    return ranked.join(days, "handle").where(near).drop("_days")


def _recent_posts_by_handle(
    posts: DataFrame, newest: int, dated: DataFrame | None = None,
    window_days: int = RELEASE_WINDOW_DAYS,
) -> DataFrame:
    # At most `newest` posts per handle reach the array, so its size is bounded.
    ranked = latest_posts(
        posts.select("handle", "shortcode", "post_date", "likes", "comments", "caption"),
        newest, rank="post_rank",
    )
    if dated is not None:
        ranked = _near_releases(ranked, dated, window_days)
    entry = F.struct(
        F.col("post_rank").alias("instagram_post_rank"),
        F.col("shortcode").alias("instagram_post_id"),
        F.col("post_date").alias("instagram_post_date"),
        F.col("likes").alias("instagram_likes"),
        F.col("comments").alias("instagram_comments"),
        F.coalesce("caption", F.lit("")).alias("instagram_caption"),
    )
    return ranked.groupBy("handle").agg(F.array_sort(F.collect_list(entry)).alias("recent"))


#: Bin of posts without a date, before all others, and the only bin of most handles.
UNDATED, WHOLE = -(1 << 31), 0
#: Posts of a handle that make one group; a handle with more is cut into bins of days.
GROUP_POSTS = 2_000


def _large_handles(posts: DataFrame, most: int) -> DataFrame | None:
    """The handles with more than ``most`` posts, stored; None when there are none."""
    sizes = posts.groupBy("handle").agg(F.count("*").alias("_size"))
    large = stored_once(sizes.where(F.col("_size") > most).select("handle"), "large-handles")
    return None if large.isEmpty() else large.withColumn("_large", F.lit(True))


def _binned_posts(posts: DataFrame, width: int, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts with their bin, and the bins of large handles with the number of newer posts.

    A large handle's bins are ``width`` days wide and are counted once and stored.
    """
    day_bin = F.coalesce(F.floor(F.unix_date("post_date") / width), F.lit(UNDATED)).cast("bigint")
    binned = posts.join(large, "handle", "left").withColumn(
        "_bin", F.when(F.col("_large"), day_bin).otherwise(F.lit(WHOLE).cast("bigint"))
    ).drop("_large")
    sizes = posts.join(large, "handle", "left_semi").groupBy("handle", day_bin.alias("_bin")).agg(
        F.count("*").alias("_size")
    )
    later = Window.partitionBy("handle").orderBy(F.desc("_bin"))
    bins = stored_once(sizes.select(
        "handle", "_bin", (F.sum("_size").over(later) - F.col("_size")).alias("_newer")
    ), "post-bins")
    return binned, bins


def _ranked_posts(binned: DataFrame, bins: DataFrame | None) -> DataFrame:
    """Posts with their rank among all of the handle's, newest first.

    Ranks are counted within bins, after the posts of the handle's later bins, so a handle
    with very many posts is not one group.
    """
    rank = F.row_number().over(
        Window.partitionBy("handle", "_bin").orderBy(F.desc("post_date"), F.asc("shortcode"))
    )
    ranked = binned.withColumn("post_rank", rank)
    if bins is None:
        return ranked
    newer = F.coalesce("_newer", F.lit(0))
    return ranked.join(bins, ["handle", "_bin"], "left").withColumn(
        "post_rank", (newer + F.col("post_rank")).cast("int")
    ).drop("_newer")


def _binned_tracks(
    wanted: DataFrame, window_days: int, width: int, large: DataFrame, bins: DataFrame
) -> DataFrame:
    """Tracks in every bin that may hold their post."""
    edge = lambda days: F.floor((F.col("_day") + days) / width).cast("bigint")
    marked = wanted.join(large, "handle", "left")
    everywhere = F.col("_large").isNotNull() & F.col("_day").isNull()
    placed = marked.where(~everywhere).withColumn("_bin", F.explode(
        F.when(F.col("_large"), F.sequence(edge(-window_days), edge(window_days)))
        .otherwise(F.array(F.lit(WHOLE).cast("bigint")))
    )).drop("_large")
    return placed.unionByName(
        marked.where(everywhere).join(bins, "handle").select(*placed.columns)
    )


def _release_posts_of_all(
    tracks: DataFrame, posts: DataFrame, window_days: int, most: int = GROUP_POSTS
) -> DataFrame:
    """``release_posts`` over all posts of a profile.

    A handle with up to ``most`` posts is one group. For the others it is an interval join: a
    release's days lie in at most two bins as wide as the window, a post in one, so every
    pair is met once, in the post's bin; a track without a date visits all bins of its
    handle. What matches is reduced to the newest post per track before it is shuffled.
    """
    width = 2 * window_days + 1
    posts = posts.select("handle", "shortcode", "post_date", "likes", "comments", "caption").where(
        F.col("handle").isNotNull()
    )
    wanted = tracks.where(F.col("instagram_handle").isNotNull()).select(
        "track_id", F.col("instagram_handle").alias("handle"),
        "track_name", F.unix_date("release_date").alias("_day"),
    )
    large = _large_handles(posts, most)
    if large is None:
        whole = F.lit(WHOLE).cast("bigint")
        placed, binned, bins = wanted.withColumn("_bin", whole), posts.withColumn("_bin", whole), None
    else:
        binned, bins = _binned_posts(posts, width, large)
        placed = _binned_tracks(wanted, window_days, width, large, bins)
    ranked = _ranked_posts(binned, bins)
    near = F.col("_day").isNull() | (F.abs(F.unix_date("post_date") - F.col("_day")) <= window_days)
    # the words of a title are taken from it where it meets a post, not shuffled beside it
    fits = text.caption_mentions_track(F.col("caption"), F.col("track_name"))
    t, p = placed.alias("t"), ranked.alias("p")
    found = t.join(
        p, (F.col("t.handle") == F.col("p.handle")) & (F.col("t._bin") == F.col("p._bin")) & near & fits
    ).groupBy("track_id").agg(F.min(F.struct(
        F.col("post_rank").alias("instagram_post_rank"),
        F.col("shortcode").alias("instagram_post_id"),
        F.col("post_date").alias("instagram_post_date"), F.col("likes").alias("instagram_likes"),
        F.col("comments").alias("instagram_comments"),
        text.caption_excerpt(F.col("caption")).alias("instagram_caption"),
    )).alias("_post"))
    return tracks.join(found, "track_id", "left").select(*tracks.columns, "_post.*").withColumn(
        "instagram_url", text.post_url(F.col("instagram_post_id"))
    ).select(*tracks.columns, *POST_FIELDS)


def release_posts(
    tracks: DataFrame, posts: DataFrame, newest: int | None = RELEASE_POSTS,
    window_days: int = RELEASE_WINDOW_DAYS, dated: bool = False,
) -> DataFrame:
    """Each track with the newest matching post of its artist, NULL when none matches.

    Only the newest posts of a profile are searched. They are folded into one short array
    per handle, so every track meets one row in an equi-join and no track/post pairs are
    produced. A track without a release date is matched on the caption alone. With
    ``newest=None`` all posts are searched; tracks then need distinct ids. ``dated`` says that
    the tracks are stored and those with a handle have a release date: of the ranked posts
    only those near a release are then folded.
    """
    if newest is None:
        return _release_posts_of_all(tracks, posts, window_days)
    by_handle = _recent_posts_by_handle(posts, newest, tracks if dated else None, window_days)
    keyed = tracks.withColumn("_handle", spread_nulls(F.col("instagram_handle"), F.col("track_id")))
    # what follows from the title is made once per track, after the shuffle
    searched = F.inline(F.array(F.struct(
        F.lower("track_name").alias("_title"),
        text.caption_words(F.col("track_name")).alias("_words"),
    )))
    release = F.col("release_date")
    matching = F.filter(
        "recent",
        lambda p: (
            release.isNull() | (F.abs(F.datediff(p["instagram_post_date"], release)) <= window_days)
        ) & text.caption_has(
            F.lower(p["instagram_caption"]), F.col("_title"), F.col("_words")
        ),
    )
    joined = lookup_join(keyed, by_handle, "_handle", "handle", "left").select("*", searched)
    return joined.select(
        *tracks.columns, F.inline_outer(F.slice(matching, 1, 1))
    ).withColumns({
        "instagram_caption": F.substring("instagram_caption", 1, text.CAPTION_LENGTH),
        "instagram_url": text.post_url(F.col("instagram_post_id")),
    }).select(*tracks.columns, *POST_FIELDS)


def first_matching_post(tracks: DataFrame, posts: DataFrame) -> DataFrame:
    """Tracks that have a matching post, with that post's place among the newest."""
    return release_posts(tracks, posts).where(F.col("instagram_post_id").isNotNull())


def song_records(
    tracks: DataFrame, search: DataFrame, videos: DataFrame, posts: DataFrame,
    on: dt.date | None = None,
) -> DataFrame:
    """Final song rows; a track's release date is its video's publication date.

    Posts are looked up for dated releases only, and only those of their artists are ranked:
    the tracks with their videos are stored, so the posts can be cut to the handles. Tracks
    without a handle are not moved for the posts.
    """
    with_video = track_video(tracks.drop("release_date"), search, videos).withColumnRenamed(
        "youtube_published_date", "release_date"
    )
    dated = stored_once(with_video.drop("youtube_url").withColumn(
        "instagram_handle",
        F.when(F.col("release_date").isNotNull(), text.handle_clean(F.col("instagram_handle"))),
    ), "dated-tracks")
    known = F.col("instagram_handle").isNotNull()
    with_post = release_posts(
        dated.where(known), only_wanted(posts, dated, "handle", "instagram_handle"), dated=True
    ).unionByName(dated.where(~known), allowMissingColumns=True)
    day = F.lit(on) if on else F.current_date()
    return with_post.withColumns({
        "youtube_published_date": F.col("release_date"),
        "youtube_url": text.video_url(F.col("youtube_video_id")), "collection_date": day,
    }).select(*schemas.names(schemas.SONG))
