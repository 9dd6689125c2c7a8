"""Every operator bound to the derived inputs: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import config, schemas
from ..functions import metrics, text
from ..operators import (
    distribution, filters, groups, matching, merge, posts as post_ops, songs, videos as video_ops,
)
from ..operators.discovery import discover
from ..plans import enrichment, reports, scoring
from ..plans.view import ArtistView
from ..session import scratch_dir, stored_once
from ..sources import clustered, logs, payloads, sinks, tables
from ..streaming import changes, event_time, upsert
from .fixture import AMOUNTS, BATCH_TIME, Fixture

BATCH_DATE = BATCH_TIME.date()
DESCRIBED = (
    "lastfm_listeners", "lastfm_playcount", "lastfm_playcount_per_listener",
    "instagram_followers", "instagram_engagement_rate", "instagram_avg_likes",
    "youtube_subscribers", "youtube_total_views", "underrated_ratio", "engagement_score",
    "platform_count", "priority_score", "follower_gap", "youtube_avg_views_per_video",
    "data_quality_score",
)
SPLIT_DAY = "2024-01-16"
CHOSEN_GENRES = ("jazz", "soul", "indie folk")
CHOSEN_ARTIST = "Customer#000000007"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a stable number of digits; their sums depend on row order."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields
    ])


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, small integers as BIGINT, lists joined: comparable values."""
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def scored(fx: Fixture, profile: str = "table") -> DataFrame:
    return scoring.score(fx.raw, config.PROFILES[profile])


# --- sources and sinks ---------------------------------------------------------------


def read_source(fx: Fixture) -> DataFrame:
    path = scratch_dir(fx.spark, "listening")
    sinks.write_report_csv(fx.listening, path)
    return tables.read_source(fx.spark, path, schemas.LISTENING)


def read_source_text(fx: Fixture) -> DataFrame:
    """A round trip of counts written as decimals and texts with line breaks and quotes."""
    path = scratch_dir(fx.spark, "loose")
    loose = fx.listening.withColumns({
        "lastfm_listeners": F.format_string("%.1f", F.col("lastfm_listeners").cast("double")),
        "genres": F.concat("genres", F.lit('\n"'), "primary_genre", F.lit('", more')),
    })
    sinks.write_report_csv(loose, path)
    return tables.read_source(fx.spark, path, schemas.LISTENING, multi_line=True).select(
        "artist_id", "artist_name", "lastfm_listeners", "genres"
    )


def optional_source(fx: Fixture) -> DataFrame:
    absent = tables.optional_source(fx.spark, scratch_dir(fx.spark, "absent"), schemas.VIDEO)
    return merge.merge_sources(fx.listening, fx.social, absent, BATCH_TIME).select(
        "artist_id", "instagram_followers", "youtube_channel_id", "youtube_subscribers",
        "data_quality_score",
    )


def write_report_csv(fx: Fixture) -> DataFrame:
    path = scratch_dir(fx.spark, "report")
    report = fx.raw.select("artist_name", "primary_genre", "lastfm_listeners")
    sinks.write_report_csv(report, path)
    return tables.read_source(fx.spark, path, report.schema)


def _external(fx: Fixture, kind: str) -> tuple[str, str]:
    path = scratch_dir(fx.spark, kind)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def write_raw_table(fx: Fixture) -> DataFrame:
    name, path = _external(fx, "raw")
    sinks.write_raw_table(fx.raw, name, path)
    return fx.spark.table(name).select(*schemas.names(schemas.RAW))


def write_source_table(fx: Fixture) -> DataFrame:
    """A bucketed source table, replaced once."""
    name, path = _external(fx, "social")
    for rows in (fx.social.where("instagram_followers < 20000"), fx.social):
        sinks.write_source_table(rows, name, 8, path)
    return fx.spark.table(name)


def load_sources(fx: Fixture) -> DataFrame:
    """Scores that follow from three stored sources, written and merged by one call."""
    name, path = _external(fx, "load")
    tables_ = [f"{name}_{s}" for s in ("listening", "social", "video")]
    sinks.load_sources(
        fx.listening, fx.social, fx.video, tables_, f"{name}_raw", f"{name}_scores", 8, BATCH_TIME,
        path,
    )
    return fx.spark.table(f"{name}_scores")


def build_scores_table(fx: Fixture) -> DataFrame:
    name, path = _external(fx, "scores")
    sinks.build_scores_table(fx.raw, name, path=path)
    return fx.spark.table(name)


def _insight(fx: Fixture, extract: str, report: DataFrame) -> DataFrame:
    """One of the written report extracts, read back under its report's schema."""
    path = scratch_dir(fx.spark, "insights")
    sinks.write_insights(scored(fx), path)
    return tables.read_source(fx.spark, f"{path}/{extract}", report.schema)


def read_log(fx: Fixture) -> DataFrame:
    path = scratch_dir(fx.spark, "log")
    fx.log_lines.select("value").write.text(path)
    return logs.log_events(logs.read_log(fx.spark, path)).drop("line_ord")


def _rejects(fx: Fixture, kind: str) -> tuple[DataFrame, DataFrame, dict]:
    bodies = {"artist_info": fx.info_payloads, "channels": fx.channel_payloads, "videos": fx.video_payloads}
    return payloads.split_rejects(bodies[kind], kind, scratch_dir(fx.spark, kind))


def payload_account(fx: Fixture) -> DataFrame:
    """Payloads accepted and rejected by cause, observed while they are written."""
    rows, fx = [], fx.kept(cluster=False)
    for kind in ("artist_info", "channels", "videos"):
        _, _, counts = _rejects(fx, kind)
        rows.append((kind, *[counts[c] for c in ("payloads", "accepted", "unreadable", "incomplete", "broken_number")]))
    return fx.spark.createDataFrame(
        rows, "kind string, payloads bigint, accepted bigint, unreadable bigint, incomplete bigint, broken bigint"
    )


def payload_rejects(fx: Fixture) -> DataFrame:
    """Artists whose payloads were rejected, and how many rows the accepted ones give."""
    accepted, rejected, _ = _rejects(fx, "artist_info")
    parsed = payloads.parse_artist_info(accepted).select("query_name", F.lit("accepted").alias("fate"))
    return parsed.unionByName(rejected.select("query_name", F.col("fault").alias("fate")))


# --- incremental ---------------------------------------------------------------------


def _stream(fx: Fixture) -> dict[str, str]:
    """Land and fold the early events, then land the late ones and resume."""
    base = scratch_dir(fx.spark, "stream")
    places = {k: f"{base}/{k}" for k in ("landing", "target", "checkpoint", "stats")}
    late = F.col("batch") >= F.lit(SPLIT_DAY).cast("date")
    for part in (~late, late):
        fx.batches.where(part).write.mode("append").parquet(places["landing"])
        _fold(fx, places)
    return places


def _fold(fx: Fixture, places: dict[str, str]) -> None:
    upsert.stream_upsert(
        fx.spark, places["landing"], fx.batches.schema, places["target"],
        places["checkpoint"], order=("collection_timestamp", "event_id"),
        stats=places["stats"],
    ).awaitTermination()


def stream_upsert(fx: Fixture) -> DataFrame:
    places = _stream(fx)
    return upsert.current(
        fx.spark, places["target"], fx.batches.schema, ["artist_id"],
        ["collection_timestamp", "event_id"],
    ).select("artist_id", "event_id", "source", "value")


def refresh_merged(fx: Fixture) -> DataFrame:
    """The newest of two merged versions."""
    path, fx = scratch_dir(fx.spark, "merged"), fx.stored("listening", "social")
    empty = tables.empty_source(fx.spark, schemas.VIDEO)
    upsert.refresh_merged(fx.listening, fx.social, empty, path, 0, BATCH_TIME)
    newest = upsert.refresh_merged(fx.listening, fx.social, fx.video, path, 1, BATCH_TIME)
    return fx.spark.read.schema(schemas.RAW).parquet(newest)


def compact(fx: Fixture) -> DataFrame:
    """Current rows read from a snapshot of all batches."""
    places, order = _stream(fx), ["collection_timestamp", "event_id"]
    snapshot = scratch_dir(fx.spark, "snapshot")
    upsert.compact(
        fx.spark, places["target"], fx.batches.schema, ["artist_id"], order, snapshot
    )
    return upsert.current(
        fx.spark, scratch_dir(fx.spark, "no-batches"), fx.batches.schema, ["artist_id"], order,
        snapshot,
    ).select("artist_id", "event_id", "source", "value")


def batch_stats(fx: Fixture) -> DataFrame:
    places = _stream(fx)
    return fx.spark.read.parquet(places["stats"]).select(
        F.col("batch").cast("bigint").alias("batch"), "source", "arrived", "artists",
        "new_artists",
    )


def resume(fx: Fixture) -> DataFrame:
    """Totals after a restart that finds nothing new."""
    places = _stream(fx)
    _fold(fx, places)
    return fx.spark.read.parquet(places["stats"]).agg(
        F.count("*").alias("batches"), F.sum("arrived").alias("arrived"),
        F.sum("new_artists").alias("artists"),
    )


def _landed_twice(fx: Fixture, label: str, start) -> str:
    """Run a stream over the early events, land the late ones and run it again; its target."""
    base = scratch_dir(fx.spark, label)
    late = F.col("batch") >= F.lit(SPLIT_DAY).cast("date")
    for part in (~late, late):
        fx.batches.where(part).write.mode("append").parquet(f"{base}/landing")
        start(f"{base}/landing", f"{base}/target", f"{base}/checkpoint").awaitTermination()
    return f"{base}/target"


def source_counts_by_time(fx: Fixture) -> DataFrame:
    """Counts of the days that are over, two days after them."""
    target = _landed_twice(fx, "counts", lambda landing, target, checkpoint: (
        event_time.stream_source_counts(
            fx.spark, landing, fx.batches.schema, target, checkpoint, ["event_id"], late="2 days")
    ))
    return fx.spark.read.parquet(target).select("source", F.col("start").cast("date").alias("day"), "n")


def newest_by_state(fx: Fixture) -> DataFrame:
    order = ("collection_timestamp", "event_id")
    target = _landed_twice(fx, "newest", lambda landing, target, checkpoint: (
        event_time.stream_newest(
            fx.spark, landing, fx.batches.schema, target, checkpoint, order=order, late="3650 days")
    ))
    return upsert.current(
        fx.spark, target, fx.batches.schema, ["artist_id"], order
    ).select("artist_id", "event_id", "source", "value")


def _clustered(fx: Fixture) -> str:
    path = scratch_dir(fx.spark, "clustered")
    rows = stored_once(scored(fx), "scored")
    clustered.write_clustered(rows, path, file_rows=max(1, rows.count() // 8))
    return path


def kept_store(fx: Fixture) -> changes.MergedStore:
    """The merged store after all arrivals, batch by batch."""
    store = changes.MergedStore(fx.spark, scratch_dir(fx.spark, "kept"), buckets=16)
    for number, batches in enumerate(fx.stored("listening", "social", "video").arrivals):
        store.refresh(number, batches, BATCH_TIME)
    return store


def append_batch(fx: Fixture) -> DataFrame:
    late = F.col("batch") >= F.lit(SPLIT_DAY).cast("date")
    return groups.append_batch(
        fx.batches.where(~late), fx.batches.where(late).drop("batch"),
        ["artist_id"], ["collection_timestamp", "event_id"],
    ).select("artist_id", "event_id", "source", "value", "batch")


# --- matching ------------------------------------------------------------------------


def _candidates(fx: Fixture) -> DataFrame:
    """Of the uploads' amounts only the views are read."""
    fx = fx.kept(amounts=["views"])
    return matching.handle_candidates(
        fx.listening, fx.channel_search, fx.channels.drop("artist_id"), fx.videos
    )


def _name_candidates(fx: Fixture) -> DataFrame:
    return fx.listening.select(
        "artist_id", "artist_name",
        F.posexplode(text.name_handle_variants(F.col("artist_name"))).alias("position", "handle"),
    )


def _scored_channels(fx: Fixture) -> DataFrame:
    return matching.artist_channel_candidates(
        fx.listening, fx.channel_search, fx.channels.drop("artist_id")
    )


def _dashboard(fx: Fixture) -> ArtistView:
    return ArtistView(scored(fx))


# Jobs that use the uploads more than once have them joined once and stored.


def track_video(fx: Fixture) -> DataFrame:
    fx = fx.kept(cluster=False)
    return songs.track_video(fx.chart.select("track_id", "artist_id"), fx.video_search, fx.videos)


def song_records(fx: Fixture) -> DataFrame:
    fx = fx.kept(cluster=False, amounts=AMOUNTS, titled=True)
    return songs.song_records(fx.tracks, fx.video_search, fx.videos, fx.posts, BATCH_DATE)


def song_catalogue(fx: Fixture) -> DataFrame:
    """Of the social rows only the handles are read."""
    fx = fx.kept(cluster=False, amounts=AMOUNTS, titled=True)
    return enrichment.song_catalogue(
        fx.listening, fx.social_handles, fx.chart.drop("artist_name", "instagram_handle"),
        fx.video_search, fx.videos, fx.posts, BATCH_DATE)


def social_profiles(fx: Fixture) -> DataFrame:
    fx = fx.kept()
    return enrichment.social_profiles(
        fx.listening, fx.channel_search, fx.channels.drop("artist_id"), fx.videos,
        fx.profiles, fx.posts)


def video_channels(fx: Fixture) -> DataFrame:
    fx = fx.kept()
    return enrichment.video_channels(
        fx.listening, fx.channel_search, fx.channels.drop("artist_id"), fx.videos)


LISTED = ("artist_id", "artist_name", "lastfm_listeners")

QUERIES: dict[str, Callable[[Fixture], DataFrame]] = {
    # sources and sinks
    "read_source": read_source,
    "optional_source": optional_source,
    "parse_tag_hits": lambda fx: payloads.parse_tag_hits(fx.tag_payloads),
    "parse_geo_hits": lambda fx: payloads.parse_geo_hits(fx.chart_payloads),
    "parse_artist_info": lambda fx: payloads.parse_artist_info(fx.info_payloads),
    "parse_top_tracks": lambda fx: payloads.parse_top_tracks(fx.track_payloads),
    "parse_channels": lambda fx: payloads.parse_channels(fx.channel_payloads),
    "parse_videos": lambda fx: payloads.parse_videos(fx.video_payloads),
    "scan_scores": lambda fx: reports.scan_scores(scored(fx)),
    "write_report_csv": write_report_csv,
    "read_source_text": read_source_text,
    "insights_top": lambda fx: _insight(
        fx, "top_underrated_artists", reports.top_underrated(scored(fx), 20)),
    "insights_genres": lambda fx: rounded(
        _insight(fx, "genre_analysis", reports.genre_summary(scored(fx)))),
    "insights_growth": lambda fx: _insight(
        fx, "high_growth_artists", reports.high_growth(scored(fx))),
    "read_log": read_log,
    "write_raw_table": write_raw_table,
    "build_scores_table": build_scores_table,
    "write_source_table": write_source_table,
    "load_sources": load_sources,
    # projections
    "artist_id": lambda fx: fx.table("customer").select(
        "c_custkey", metrics.artist_id(F.col("c_name")).alias("artist_id")),
    "plays_per_listener": lambda fx: fx.artists.select(
        "artist_id", metrics.plays_per_listener(F.col("playcount"), F.col("listeners"))
        .alias("plays_per_listener")),
    "genre_tags": lambda fx: payloads.parse_artist_info(fx.info_payloads).select(
        "artist_id", "genres", F.size("genre_tags").alias("n_tags")),
    "primary_genre": lambda fx: payloads.parse_artist_info(fx.info_payloads).select(
        "artist_id", "primary_genre"),
    "underrated_ratio": lambda fx: fx.raw.select(
        "artist_id", metrics.underrated_ratio().alias("underrated_ratio")),
    "engagement_score": lambda fx: fx.raw.select(
        "artist_id", metrics.engagement_score().alias("engagement_score")),
    "platform_count": lambda fx: fx.raw.select(
        "artist_id", metrics.platform_count().alias("platform_count")),
    "growth_potential": lambda fx: fx.raw.select("artist_id", *[
        metrics.growth_potential(c).alias(f"growth_{n}") for n, c in config.PROFILES.items()]),
    "priority_score": lambda fx: fx.raw.select(
        "artist_id", metrics.priority_score().alias("priority_score")),
    "follower_gap": lambda fx: fx.raw.select(
        "artist_id", metrics.follower_gap().alias("follower_gap")),
    "data_quality_score": lambda fx: fx.raw.select("artist_id", "data_quality_score"),
    "zero_fill": lambda fx: merge.zero_fill(fx.raw),
    "channel_avg_views": lambda fx: fx.channels.select(
        "channel_id", metrics.channel_avg_views(F.col("views"), F.col("videos"))
        .alias("avg_views")),
    "display_rows": lambda fx: reports.display_rows(scored(fx)),
    "engagement_label": lambda fx: fx.raw.select(
        "artist_id", metrics.engagement_label(F.col("instagram_engagement_rate"))
        .alias("engagement")),
    "handle_clean": lambda fx: fx.raw.select("artist_id", text.handle_clean(
        F.concat(F.lit("@"), "instagram_handle")).alias("handle")),
    "post_projection": lambda fx: songs.post_projection(fx.posts),
    "published_date": lambda fx: fx.videos.select(
        "video_id", text.published_date(F.col("published_at")).alias("published_date")),
    "stamp_collection": lambda fx: merge.stamp_collection(
        fx.listening.select("artist_id"), BATCH_TIME),
    "extract_handles": lambda fx: fx.handle_text.select("doc_id", F.posexplode(
        text.extract_handles(F.col("text"))).alias("position", "handle")),
    "name_handle_variants": lambda fx: _name_candidates(fx).select(
        "artist_id", "position", "handle"),
    "name_words": lambda fx: fx.table("documents").select(
        "doc_id", text.profile_name_words(F.col("text")).alias("profile_words"),
        text.channel_name_words(F.col("text")).alias("channel_words")),
    "channel_match_score": lambda fx: fx.channels.join(
        fx.listening.select("artist_id", "artist_name"), "artist_id").select(
        "channel_id", text.channel_match_score(
            text.channel_name_words(F.col("artist_name")), F.col("title"),
            F.col("description"), F.col("subscribers")).alias("match_score")),
    "log_presence_pairs": lambda fx: rounded(reports.log_presence_pairs(scored(fx))),
    "ratio_side": lambda fx: reports.ratio_sides(scored(fx)),
    "ratio_share_above": lambda fx: distribution.share_above(scored(fx), "underrated_ratio"),
    # filters
    "emerging_filter": lambda fx: filters.emerging_filter(fx.listening).select(*LISTED),
    "exclude_established": lambda fx: filters.exclude_established(
        fx.listening, [*config.ESTABLISHED_ARTISTS, "CUSTOMER#000000003"]).select(*LISTED),
    "scoring_filter": lambda fx: filters.scoring_filter(fx.raw).select(*LISTED),
    "min_profile_followers": lambda fx: filters.min_profile_followers(fx.profiles).select(
        "handle", "followers"),
    "channel_candidates_filter": lambda fx: filters.channel_candidates_filter(
        fx.channels).select("channel_id", "subscribers"),
    "channel_size_filter": lambda fx: filters.channel_size_filter(fx.channels).select(
        "channel_id", "subscribers"),
    "caption_mentions_track": lambda fx: fx.chart.join(
        fx.uploads.select(F.concat(F.lit("tr"), "l_orderkey").alias("track_id"),
                          F.col("code").alias("shortcode"))
        .join(fx.posts.select("shortcode", "caption"), "shortcode"), "track_id").select(
        "track_id", "shortcode", text.caption_mentions_track(
            F.col("caption"), F.col("track_name")).alias("mentioned")),
    "by_growth": lambda fx: filters.by_growth(scored(fx), "High Potential").select(
        *LISTED, "growth_potential"),
    "by_genre": lambda fx: filters.by_genre(scored(fx)).select(*LISTED, "primary_genre"),
    "by_genre_chosen": lambda fx: filters.by_genre(scored(fx), CHOSEN_GENRES).select(
        *LISTED, "primary_genre"),
    "by_follower_range": lambda fx: filters.by_follower_range(scored(fx), 20_000, 80_000).select(
        *LISTED, "instagram_followers"),
    "complete_artists": lambda fx: filters.complete_artists(scored(fx)).select(*LISTED),
    "with_ratio": lambda fx: filters.with_ratio(scored(fx)).select(*LISTED, "underrated_ratio"),
    "by_min_listeners": lambda fx: filters.by_min_listeners(fx.listening).select(*LISTED),
    "by_engagement": lambda fx: filters.by_engagement(scored(fx), 3.0).select(
        *LISTED, "instagram_engagement_rate"),
    # joins
    "merge_sources": lambda fx: fx.raw,
    "attach_handles": lambda fx: merge.attach_handles(fx.listening, fx.social).select(
        *LISTED, "instagram_handle"),
    "verify_handles": lambda fx: matching.verify_handles(_candidates(fx), fx.profiles).select(
        "artist_id", "source_ord", "position", "handle"),
    "existing_profiles": lambda fx: matching.existing_profiles(
        _name_candidates(fx), fx.profiles).select("artist_id", "position", "handle"),
    "artist_channel_candidates": lambda fx: _scored_channels(fx).select(
        "artist_id", "channel_id", "search_rank", "subscribers", "match_score"),
    "track_video": track_video,
    "release_posts": lambda fx: songs.release_posts(fx.chart, fx.posts).select(
        "track_id", "track_name", *songs.POST_FIELDS),
    "release_posts_all": lambda fx: songs.release_posts(fx.chart, fx.posts, newest=None).select(
        "track_id", "track_name", *songs.POST_FIELDS),
    "song_records": song_records,
    # aggregations
    "genre_summary": lambda fx: rounded(reports.genre_summary(scored(fx))),
    "growth_summary": lambda fx: reports.growth_summary(scored(fx)),
    "genre_counts": lambda fx: reports.genre_counts(scored(fx)),
    "genre_counts_top": lambda fx: reports.genre_counts(fx.listening, 10),
    "overview_metrics": lambda fx: reports.overview_metrics(scored(fx)),
    "coverage_counts": lambda fx: reports.coverage_counts(fx.raw),
    "listener_range_stats": lambda fx: reports.listener_range_stats(fx.listening),
    "source_means": lambda fx: rounded(
        reports.source_means(fx.listening, fx.social, fx.video)),
    "success_rate": lambda fx: rounded(reports.success_rate(fx.listening, fx.social)),
    "describe_scores": lambda fx: rounded(distribution.describe_scores(scored(fx), DESCRIBED), 4),
    "histogram": lambda fx: rounded(distribution.histogram(scored(fx), "priority_score", 50)),
    "ratio_histogram": lambda fx: rounded(
        distribution.histogram(scored(fx), "underrated_ratio", 20)),
    "platform_normalised": lambda fx: rounded(distribution.platform_normalised(scored(fx))),
    "key_insights": lambda fx: rounded(reports.key_insights(scored(fx))),
    "source_row_counts": lambda fx: reports.source_row_counts(fx.batches),
    "last_updated": lambda fx: reports.last_updated(fx.raw),
    "post_engagement": lambda fx: post_ops.post_engagement(fx.posts, fx.profiles),
    "recent_video_mean": lambda fx: video_ops.recent_video_mean(fx.videos),
    "quota_estimate": lambda fx: reports.quota_estimate(fx.listening),
    # ranking and windows
    "first_hit_per_artist": lambda fx: groups.first_hit_per_artist(
        payloads.parse_tag_hits(fx.tag_payloads).unionByName(
            payloads.parse_geo_hits(fx.chart_payloads))),
    "latest_per_artist": lambda fx: groups.latest_per_artist(
        fx.batches, ["collection_timestamp", "event_id"]).select(
        "artist_id", "event_id", "source", "value"),
    "display_rank": lambda fx: reports.display_rank(scored(fx)).select(
        "rank", "artist_id", "artist_name", "priority_score"),
    "full_rank": lambda fx: reports.full_rank(scored(fx)).select(
        "rank", "artist_id", "artist_name", "priority_score"),
    "latest_posts": lambda fx: post_ops.latest_posts(fx.posts, rank="newest").select(
        "handle", "shortcode", "newest"),
    "largest_channel": lambda fx: matching.largest_channel(
        fx.channel_search, fx.channels.drop("artist_id")).select(
        "artist_id", "channel_id", "subscribers"),
    "best_channel": lambda fx: matching.best_channel(_scored_channels(fx)).select(
        "artist_id", "channel_id", "subscribers", "match_score"),
    "resolve_handle": lambda fx: matching.resolve_handle(_candidates(fx), fx.profiles),
    "recent_videos": lambda fx: video_ops.recent_videos(fx.videos, rank="newest").select(
        "channel_id", "video_id", "newest"),
    "default_artist": lambda fx: reports.default_artist(scored(fx)).select(*LISTED),
    "top_tracks": lambda fx: songs.top_tracks(fx.chart).select(
        "artist_id", "track_id", "lastfm_rank"),
    "quota_prefix": lambda fx: reports.quota_prefix(fx.attempts),
    "quota_prefix_ranges": lambda fx: reports.quota_prefix(fx.attempts, in_one_task=0),
    "payload_account": payload_account,
    "payload_rejects": payload_rejects,
    "first_matching_post": lambda fx: songs.first_matching_post(fx.tracks, fx.posts).select(
        "track_id", "instagram_post_rank", "instagram_post_id"),
    # top-k, limits, sets
    "top_underrated": lambda fx: reports.top_underrated(scored(fx)),
    "high_growth": lambda fx: reports.high_growth(scored(fx)),
    "scored_artists": lambda fx: scoring.scored_artists(fx.raw),
    "scored_artists_generated": lambda fx: scoring.scored_artists(fx.raw, config.GENERATED),
    "scored_artists_documented": lambda fx: scoring.scored_artists(fx.raw, config.DOCUMENTED),
    "score_zero_filled": lambda fx: scoring.score_zero_filled(fx.raw),
    "sample_rows": lambda fx: reports.sample_rows(fx.raw).select(*LISTED),
    "option_lists": lambda fx: reports.option_lists(scored(fx)),
    "artist_detail": lambda fx: _dashboard(fx).by_growth("High Potential").detail(CHOSEN_ARTIST),
    "top3_flag": lambda fx: reports.top3_flag(reports.display_rank(scored(fx))).select(
        "rank", "artist_id", "highlighted"),
    "discover": lambda fx: discover(
        payloads.parse_tag_hits(fx.tag_payloads), payloads.parse_geo_hits(fx.chart_payloads)),
    "append_batch": append_batch,
    "dashboard_view": lambda fx: _dashboard(fx).by_growth("All Artists").by_genre(
        CHOSEN_GENRES).by_followers(10_000, 90_000).by_engagement(2.0).table(),
    # incremental
    "stream_upsert": stream_upsert,
    "batch_stats": batch_stats,
    "resume": resume,
    "compact": compact,
    "refresh_merged": refresh_merged,
    "source_counts_by_time": source_counts_by_time,
    "newest_by_state": newest_by_state,
    "clustered_top": lambda fx: clustered.read_top(fx.spark, _clustered(fx), 50).select(
        *reports.TOP_COLUMNS),
    "clustered_rank": lambda fx: clustered.read_ranked(fx.spark, _clustered(fx)).select(
        "rank", "artist_id", "artist_name", "priority_score"),
    "refresh_changes": lambda fx: kept_store(fx).merged(),
    "kept_scores": lambda fx: kept_store(fx).scored(),
    "kept_genre_summary": lambda fx: rounded(changes.kept_genre_summary(kept_store(fx).summary())),
    "kept_growth_summary": lambda fx: changes.kept_growth_summary(kept_store(fx).summary()),
    "kept_source_counts": lambda fx: changes.kept_source_counts(kept_store(fx).summary()),
    "log_events": lambda fx: logs.log_events(fx.log_lines).drop("line_ord"),
    "recent_log_events": lambda fx: logs.recent_log_events(
        logs.log_events(fx.log_lines)).drop("line_ord"),
    "rate_limit_seen": lambda fx: logs.rate_limit_seen(logs.log_events(fx.log_lines)),
    "recent_progress": lambda fx: logs.recent_progress(
        logs.log_events(fx.log_lines)).drop("line_ord"),
    # compositions
    "discover_artists": lambda fx: enrichment.discover_artists(
        fx.tag_payloads, fx.chart_payloads, fx.info_payloads, at=BATCH_TIME),
    "social_profiles": social_profiles,
    "video_channels": video_channels,
    "song_catalogue": song_catalogue,
}


@lru_cache(maxsize=4)
def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


def bind(key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(QUERIES[key](fixture(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: bind(key) for key in QUERIES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge, score, keep the best fifty and rank them."""
    return plain(reports.display_rank(scored(fixture(spark, sf_dir))).select(
        "rank", "artist_id", *reports.TOP_COLUMNS))
