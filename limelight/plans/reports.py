"""Reports over the scored table and the per-source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config
from ..functions import metrics
from ..functions.numeric import array_round, ratio
from ..operators.filters import by_growth
from ..operators.groups import first_n_per_group, score_order
from ..session import stored_once

TOP_COLUMNS = (
    "artist_name", "primary_genre", "priority_score", "underrated_ratio", "engagement_score",
    "instagram_followers", "lastfm_listeners", "youtube_subscribers", "growth_potential",
)
HIGH_GROWTH_COLUMNS = (
    "artist_name", "primary_genre", "priority_score", "underrated_ratio",
    "instagram_followers", "lastfm_listeners", "follower_gap", "engagement_score",
)


def scan_scores(scored: DataFrame) -> DataFrame:
    return scored.orderBy(*score_order())


def top_underrated(scored: DataFrame, n: int = 50) -> DataFrame:
    return scored.orderBy(*score_order()).limit(n).select(*TOP_COLUMNS)


def high_growth(scored: DataFrame, n: int = 30) -> DataFrame:
    return by_growth(scored, "High").orderBy(*score_order()).limit(n).select(*HIGH_GROWTH_COLUMNS)


def genre_summary(scored: DataFrame) -> DataFrame:
    """Per genre, NULL genre included, best mean score first."""
    return scored.groupBy("primary_genre").agg(
        F.count("*").alias("artist_count"),
        F.avg("priority_score").alias("avg_priority_score"),
        F.avg("underrated_ratio").alias("avg_underrated_ratio"),
        F.avg("engagement_score").alias("avg_engagement"),
        F.count_if(F.col("growth_potential") == "High").alias("high_growth_count"),
        F.avg("instagram_followers").alias("avg_instagram_followers"),
        F.avg("lastfm_listeners").alias("avg_lastfm_listeners"),
    ).orderBy(F.col("avg_priority_score").desc_nulls_last(), "primary_genre")


def growth_summary(scored: DataFrame) -> DataFrame:
    summary = scored.where(F.col("growth_potential").isNotNull()).groupBy("growth_potential").agg(
        F.count("artist_name").alias("artist_count"),
        F.avg("priority_score").alias("mean_score"),
        F.avg("underrated_ratio").alias("mean_ratio"),
    ).orderBy(F.col("mean_score").desc_nulls_last(), "growth_potential")
    return summary.select(
        "growth_potential", "artist_count",
        array_round(F.col("mean_score"), 2).alias("avg_priority_score"),
        array_round(F.col("mean_ratio"), 2).alias("avg_underrated_ratio"),
    )


def genre_counts(df: DataFrame, top: int | None = None, more_than: int = 0) -> DataFrame:
    """Artists per known genre, most frequent first.

    Empty unless the table covers more than ``more_than`` genres, a NULL genre counting
    as one of them.
    """
    per_genre = df.groupBy("primary_genre").agg(F.count("*").alias("artists"))
    if more_than:
        covered = per_genre.agg(F.count("*")).scalar()
        per_genre = per_genre.where(covered > more_than)
    counts = per_genre.where(F.col("primary_genre").isNotNull()).orderBy(
        F.desc("artists"), "primary_genre"
    )
    return counts.limit(top) if top else counts


def overview_metrics(scored: DataFrame) -> DataFrame:
    """Total, High count and distinct genres; a NULL genre counts as one more genre."""
    genre = F.col("primary_genre")
    per_genre = scored.groupBy("primary_genre").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("growth_potential") == "High").alias("high"),
    )
    return per_genre.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_artists"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high_potential"),
        (F.count(genre) + F.count_if(genre.isNull())).alias("genres_covered"),
    )


def coverage_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("artists"),
        F.count("instagram_followers").alias("with_social"),
        F.count("youtube_subscribers").alias("with_video"),
    )


def listener_range_stats(
    listening: DataFrame, edges: tuple[int, int] = config.LISTENER_REPORT_EDGES
) -> DataFrame:
    listeners = F.col("lastfm_listeners")
    low, high = edges
    return listening.agg(
        F.min(listeners).alias("min_listeners"), F.max(listeners).alias("max_listeners"),
        F.count_if(listeners.between(low, high)).alias("in_range"),
        F.count_if(listeners > high).alias("above_range"),
        F.count_if(listeners < low).alias("below_range"),
    )


def listening_means(listening: DataFrame) -> DataFrame:
    return listening.agg(
        F.avg("lastfm_listeners").alias("avg_listeners"),
        F.avg("lastfm_playcount").alias("avg_playcount"),
        F.avg("lastfm_playcount_per_listener").alias("avg_plays_per_listener"),
    )


def social_means(social: DataFrame, target: tuple[int, int] = (10_000, 100_000)) -> DataFrame:
    return social.agg(
        F.avg("instagram_followers").alias("avg_followers"),
        F.avg("instagram_engagement_rate").alias("avg_engagement_rate"),
        F.count_if(F.col("instagram_followers").between(*target)).alias("in_target_range"),
    )


def video_means(video: DataFrame) -> DataFrame:
    return video.agg(
        F.avg("youtube_subscribers").alias("avg_subscribers"),
        F.avg("youtube_total_views").alias("avg_total_views"),
        F.avg("youtube_avg_views_per_video").alias("avg_views_per_video"),
    )


def source_means(listening: DataFrame, social: DataFrame, video: DataFrame) -> DataFrame:
    """The per-source summaries in one long table (source, measure, value)."""
    def long(df: DataFrame, source: str) -> DataFrame:
        pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in df.columns)
        return df.selectExpr(
            f"'{source}' AS source", f"stack({len(df.columns)}, {pairs}) AS (measure, value)"
        )

    return (
        long(listening_means(listening), "listening")
        .unionByName(long(social_means(social), "social"))
        .unionByName(long(video_means(video), "video"))
    )


def success_rate(artists: DataFrame, found: DataFrame) -> DataFrame:
    """Share of processed artists that were matched, in percent."""
    matched = found.select("artist_id").distinct().withColumn("_hit", F.lit(1))
    return artists.join(matched, "artist_id", "left").agg(
        F.count("*").alias("processed"), F.count("_hit").alias("matched"),
        (ratio(F.count("_hit"), F.count("*")) * 100).alias("success_rate"),
    )


def key_insights(scored: DataFrame, n: int = 20) -> DataFrame:
    """One row: ratio statistics and leader of the top n, and the best genre.

    No row when nothing was scored.
    """
    leader = F.struct(
        "artist_name", "primary_genre", "instagram_followers", "lastfm_listeners",
        "growth_potential",
    )
    stats = display_rank(scored, n).agg(
        F.avg("underrated_ratio").alias("avg_ratio"),
        F.max("underrated_ratio").alias("max_ratio"),
        F.max_by("artist_name", F.struct("underrated_ratio", -F.col("rank")))
        .alias("max_ratio_artist"),
        F.min_by(leader, "rank").alias("leader"),
    ).where(F.col("leader").isNotNull())
    genre = genre_summary(scored).limit(1).select(F.struct(
        "primary_genre", "artist_count", "avg_priority_score", "high_growth_count"
    ).alias("genre")).scalar()
    return stats.select(
        "avg_ratio", "max_ratio", "max_ratio_artist",
        F.col("leader.artist_name").alias("top_artist"),
        F.col("leader.primary_genre").alias("top_artist_genre"),
        F.col("leader.instagram_followers").alias("top_artist_followers"),
        F.col("leader.lastfm_listeners").alias("top_artist_listeners"),
        F.col("leader.growth_potential").alias("top_artist_growth"),
        genre["primary_genre"].alias("best_genre"),
        genre["artist_count"].alias("best_genre_artists"),
        genre["avg_priority_score"].alias("best_genre_score"),
        genre["high_growth_count"].alias("best_genre_high_growth"),
    )


def source_row_counts(batches: DataFrame) -> DataFrame:
    """Rows per (source, batch) and the change since the source's previous batch."""
    counts = batches.groupBy("source", "batch").agg(F.count("*").alias("n"))
    previous = F.lag("n").over(Window.partitionBy("source").orderBy("batch"))
    return counts.withColumn("change", F.col("n") - previous)


def last_updated(df: DataFrame) -> DataFrame:
    return df.agg(F.max("collection_date").alias("last_updated"))


def quota_estimate(artists: DataFrame) -> DataFrame:
    per_artist = config.QUOTA_SEARCH + config.QUOTA_DETAIL
    return artists.agg(
        F.count("*").alias("artists"), (F.count("*") * per_artist).alias("estimated_units")
    )


def _spent_in_ranges(costed: DataFrame) -> DataFrame:
    """``spent``, the units of a day up to each attempt, for days of any length.

    Attempts are sorted into ranges by day and order, which Spark samples so that they are
    of like size, and stored with their range. A day's units before a range are the sums of
    its earlier ranges, a few rows a day; a window adds those within the range.
    """
    ranged = stored_once(
        costed.repartitionByRange("collection_date", "attempt_ord")
        .withColumn("_range", F.spark_partition_id()), "quota-ranges",
    )
    by_day = Window.partitionBy("collection_date").orderBy("_range")
    before = ranged.groupBy("collection_date", "_range").agg(F.sum("units").alias("_units")).select(
        "collection_date", "_range", (F.sum("_units").over(by_day) - F.col("_units")).alias("_before")
    )
    within = F.sum("units").over(
        Window.partitionBy("collection_date", "_range").orderBy("attempt_ord")
    )
    return ranged.withColumn("_within", within).join(
        before, ["collection_date", "_range"]
    ).withColumn("spent", F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def quota_prefix(
    attempts: DataFrame, stop: int = config.QUOTA_STOP, search: int = config.QUOTA_SEARCH,
    in_one_task: int = 100_000,
) -> DataFrame:
    """Attempts that run before each day's request budget stops the collection.

    ``attempts`` holds (collection_date, attempt_ord, artist_id, matched, accepted). Each
    attempt costs at least one search, so the budget is crossed within the first
    ``stop / search + 1`` attempts of a day. Up to ``in_one_task`` of them are cut off and
    summed up in one task; a larger budget is summed up in ranges. The collection stops at
    the first attempt from there on whose channel was not rejected, since rejected channels
    skip the check.
    """
    cost = (
        F.lit(search)
        + F.when(F.col("matched"), config.QUOTA_DETAIL).otherwise(0)
        + F.when(F.col("matched") & F.col("accepted"), config.QUOTA_VIDEOS).otherwise(0)
    )
    costed = attempts.withColumn("units", cost.cast("bigint"))
    needed = stop // search + 1
    if needed <= in_one_task:
        running = F.sum("units").over(Window.partitionBy("collection_date").orderBy("attempt_ord"))
        spent = first_n_per_group(
            costed, ["collection_date"], [F.asc("attempt_ord")], needed
        ).withColumn("spent", running)
    else:
        spent = _spent_in_ranges(costed)
    # one row per calendar day, so both broadcasts are bounded by the calendar
    crossing = (
        spent.where(F.col("spent") > stop)
        .groupBy("collection_date").agg(F.min("attempt_ord").alias("crossed_at"))
    )
    rejected = F.col("matched") & ~F.col("accepted")
    stops = (
        costed.join(F.broadcast(crossing), "collection_date")
        .where((F.col("attempt_ord") >= F.col("crossed_at")) & ~rejected)
        .groupBy("collection_date").agg(F.min("attempt_ord").alias("stopped_at"))
    )
    return (
        costed.join(F.broadcast(stops), "collection_date", "left")
        .where(F.col("stopped_at").isNull() | (F.col("attempt_ord") <= F.col("stopped_at")))
        .drop("stopped_at")
    )


def display_rank(scored: DataFrame, n: int = 50) -> DataFrame:
    """Rank 1..n by score. The cut comes first, so only n rows are numbered."""
    top = scored.orderBy(*score_order()).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*score_order())))


def full_rank(
    scored: DataFrame, ranges: int | None = None, range_rows: int = 250_000
) -> DataFrame:
    """Rank 1..n over all scored artists, without sorting them in one task.

    A few artists picked by the hash of their id cut the order into ranges of about
    ``range_rows`` rows (or into ``ranges``). The cuts hold score and id, so equal or missing
    scores, however many, are cut as well. A row finds its range by binary search, and a
    rank is the size of the ranges before plus the place within the range. The scored rows
    are computed once, into the shared scratch folder, and read from there.
    """
    scored = stored_once(scored, "rank-input")
    if ranges is None:
        ranges = -(-scored.count() // range_rows) or 1
    key = F.struct(
        F.col("priority_score").isNull(), -F.coalesce("priority_score", F.lit(0.0)), "artist_id"
    )
    # a generator, so that the key is built once per row and not once per comparison
    keyed = scored.select("*", F.explode(F.array(key)).alias("_key"))
    cuts = keyed.orderBy(F.xxhash64("artist_id"), "artist_id").limit(ranges - 1).agg(
        F.array_sort(F.collect_list("_key"))
    ).scalar()
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, ranges.bit_length())))])

    def advance(at: Column, step: Column) -> Column:
        ahead = at + step
        below = (ahead <= F.size("_cuts")) & (F.get(F.col("_cuts"), ahead - 1) < F.col("_key"))
        return F.when(below, ahead).otherwise(at)

    placed = keyed.withColumn("_cuts", cuts).withColumn(
        "_range", F.aggregate(steps, F.lit(0), advance)
    ).drop("_key", "_cuts")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    # one row per range
    offsets = sizes.select(
        "_range",
        (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*score_order()))
    return placed.join(F.broadcast(offsets), "_range", "left").withColumn(
        "rank", F.col("_before") + place
    ).drop("_range", "_before")


def top3_flag(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("highlighted", F.col("rank") <= 3)


def display_rows(scored: DataFrame, n: int = 50) -> DataFrame:
    """The ranked table as the dashboard prints it."""
    return display_rank(scored, n).select(
        "rank",
        metrics.artist_label().alias("artist"),
        metrics.social_label().alias("instagram_metrics"),
        F.col("primary_genre").alias("genre"),
        array_round(F.col("priority_score"), 2).alias("priority_score"),
        F.coalesce("growth_potential", F.lit("N/A")).alias("growth_potential"),
        array_round(F.col("underrated_ratio"), 2).alias("underrated_ratio"),
    )


def default_artist(scored: DataFrame) -> DataFrame:
    """Best artist present on all platforms, else the best artist."""
    complete = (
        F.col("instagram_followers").isNotNull() & F.col("youtube_subscribers").isNotNull()
        & F.col("lastfm_listeners").isNotNull()
    )
    return scored.orderBy(complete.desc(), *score_order()).limit(1)


def artist_detail(filtered: DataFrame, chosen: str) -> DataFrame:
    """The chosen artist's metrics, or the first filtered artist's if it was filtered out."""
    return (
        filtered.orderBy((F.col("artist_name") == chosen).desc_nulls_last(), *score_order())
        .limit(1)
        .select(
            "artist_name", "lastfm_listeners", "lastfm_playcount", "instagram_followers",
            metrics.engagement_label(F.col("instagram_engagement_rate")).alias("engagement"),
            "youtube_subscribers", "youtube_total_views",
        )
    )


def option_lists(df: DataFrame) -> DataFrame:
    """Sorted distinct artist names and genres, as (option_list, value)."""
    names = df.select(F.lit("artist").alias("option_list"), F.col("artist_name").alias("value"))
    genres = df.select(F.lit("genre").alias("option_list"), F.col("primary_genre").alias("value"))
    return names.unionByName(genres).distinct().orderBy("option_list", "value")


def sample_rows(df: DataFrame, n: int = 1_000, order: Sequence[str | Column] = ("artist_id",)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def log_presence_pairs(scored: DataFrame) -> DataFrame:
    """Points of the log-log presence chart; only positive values have a place on it."""
    listeners, followers = F.col("lastfm_listeners"), F.col("instagram_followers")
    return scored.where((listeners > 0) & (followers > 0)).select(
        "artist_id", F.log10(listeners).alias("log_listeners"),
        F.log10(followers).alias("log_followers"), "priority_score",
    )


def ratio_sides(scored: DataFrame) -> DataFrame:
    ratio_col = F.col("underrated_ratio")
    return scored.where(ratio_col.isNotNull()).select(
        "artist_id", "underrated_ratio", metrics.ratio_side(ratio_col).alias("side")
    )
