"""Physical plans: strategies the operators rely on, and behaviour under skew."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan, values
from limelight import schemas
from limelight.operators import distribution, filters, groups, matching, merge, posts, songs
from limelight.plans import reports, scoring
from limelight.registry import queries as registry
from limelight.sources import sinks
from limelight.streaming import upsert

POSTS = ("handle STRING, shortcode STRING, post_date DATE, likes BIGINT, comments BIGINT, "
         "is_video BOOLEAN, caption STRING")
TRACKS = "track_id STRING, artist_id STRING, track_name STRING, release_date DATE, instagram_handle STRING"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def raw_path(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], schemas.RAW).write.parquet(path)
    return path


def exchanges(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning|Exchange rangepartitioning|"
                          r"Exchange SinglePartition", text))


def test_top_k_is_not_a_sort(spark, raw_path):
    top = reports.top_underrated(scoring.score(spark.read.parquet(raw_path)))
    text = plan(top)
    assert "TakeOrderedAndProject" in text and exchanges(text) == 0


def test_scoring_is_one_narrow_pass_with_pushdown(spark, raw_path):
    text = plan(scoring.score(spark.read.parquet(raw_path)))
    assert exchanges(text) == 0 and "Join" not in text
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("In(primary_genre", "GreaterThanOrEqual(lastfm_listeners,5000)",
                 "LessThanOrEqual(lastfm_listeners,200000)", "IsNull(instagram_followers)",
                 "GreaterThanOrEqual(data_quality_score,0.3)"):
        assert part in pushed
    narrow = plan(reports.overview_metrics(scoring.score(spark.read.parquet(raw_path))))
    assert "genres" not in re.search(r"ReadSchema: struct<(.*?)>", narrow).group(1)


def test_block_list_is_an_anti_join(rows):
    text = plan(filters.exclude_established(rows("artist_name STRING", ("a",))))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_group_limits_run_before_the_shuffle(spark, rows):
    text = plan(posts.latest_posts(rows(POSTS)))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    text = plan(groups.latest_per_key(rows("artist_id STRING, t INT"), ["artist_id"], ["t"]))
    assert "row_number(), 1, Partial" in text


def test_release_posts_join_without_pairs(rows, no_broadcast):
    text = plan(songs.release_posts(rows(TRACKS), rows(POSTS)))
    # tracks, posts by handle, and the short arrays once more so that hot handles split
    assert exchanges(text) == 3
    assert "SortMergeJoin" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_post_engagement_shuffles_each_side_once(rows, no_broadcast):
    profiles = rows("handle STRING, followers BIGINT, followees BIGINT, mediacount BIGINT, "
                    "is_verified BOOLEAN")
    assert exchanges(plan(posts.post_engagement(rows(POSTS), profiles))) == 2


def test_resolution_reads_each_input_once(spark, rows, no_broadcast, tmp_path):
    shapes = {
        "artists": "artist_id STRING, artist_name STRING",
        "search": "artist_id STRING, channel_id STRING, search_rank BIGINT",
        "channels": "channel_id STRING, description STRING, subscribers BIGINT",
        "videos": "channel_id STRING, video_id STRING, published_at STRING, description STRING",
        "profiles": "handle STRING, full_name STRING, biography STRING, followers BIGINT",
    }
    t = {}
    for name, schema in shapes.items():
        rows(schema).write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(matching.resolve_handle(matching.handle_candidates(
        t["artists"], t["search"], t["channels"], t["videos"]), t["profiles"]))
    assert text.count("FileScan parquet") == len(shapes)


def test_bucketed_sources_merge_without_a_shuffle(spark, no_broadcast):
    for name, schema in (("listening", schemas.LISTENING), ("social", schemas.SOCIAL),
                         ("video", schemas.VIDEO)):
        row = tuple(f"{name}-{f.name}" if f.dataType.simpleString() == "string" else None
                    for f in schema.fields)
        df = spark.createDataFrame([row], schema).withColumn("artist_id", F.lit("a"))
        sinks.write_source_table(df, f"bucketed_{name}", buckets=4)
    merged = merge.merge_sources(*[spark.table(f"bucketed_{n}") for n in ("listening", "social", "video")])
    text = plan(merged)
    assert text.count("SortMergeJoin") == 2 and exchanges(text) == 0
    assert values(merged, "artist_id", "youtube_channel_id") == [("a", "video-youtube_channel_id")]


def test_quantiles_sort_at_most_so_many_values_in_a_task(rows, spark, monkeypatch):
    """What reaches the sorted groups is bounded by ``task_rows``, hot values included."""
    data = [(float(i % 1000) if i % 3 else 7.0,) for i in range(6000)]
    seen = []
    original = distribution._narrowed

    def spy(values, brackets, *rest):
        out = original(values, brackets, *rest)
        seen.append(max((b.size for b in out), default=0))
        return out

    monkeypatch.setattr(distribution, "_narrowed", spy)
    distribution.exact_quantiles(rows("x DOUBLE", *data), ["x"], [0.25, 0.5], task_rows=50)
    assert seen and seen[-1] <= 50


def test_batch_statistics_scan_only_folders_that_may_hold_a_key(spark, tmp_path, monkeypatch):
    from limelight.streaming import key_filter

    folders = {}
    for number in range(4):
        folders[number] = str(tmp_path / f"batch_id={number}")
        ids = spark.range(250 * number, 250 * (number + 1)).select(F.col("id").cast("string").alias("artist_id"))
        ids.write.parquet(folders[number])
        key_filter.write_filter(spark.read.parquet(folders[number]), ["artist_id"], folders[number])
    scanned, original = [], key_filter._numbered

    def spy(session, paths):
        scanned.extend(p for p in paths if not p.endswith("/_keys"))
        return original(session, paths)

    monkeypatch.setattr(key_filter, "_numbered", spy)
    batch = spark.range(990, 1005).select(F.col("id").cast("string").alias("artist_id"))
    df = upsert.batch_stats(spark, batch, folders, ["artist_id"], "s")
    assert df.first().asDict() == {"source": "s", "arrived": 15, "artists": 15, "new_artists": 5}
    assert folders[3] in scanned and len(set(scanned)) <= 2  # one more by a false positive, at most


def test_histogram_uses_scalar_bounds(rows):
    text = plan(distribution.histogram(rows("x DOUBLE", (1.0,)), "x", 5))
    assert "Subquery" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_query_plans_python_or_cross_joins(spark, data_dir):
    bad = re.compile(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups"
                     r"|CartesianProduct|BroadcastNestedLoopJoin")
    writers = {"read_source", "write_report_csv", "write_raw_table", "build_scores_table",
               "stream_upsert", "batch_stats", "resume", "compact", "refresh_merged", "read_log",
               "read_source_text", "insights_top", "insights_genres", "insights_growth",
               "describe_scores"}
    fx = registry.fixture(spark, data_dir)
    for key in registry.QUERIES.keys() - writers:
        found = bad.search(plan(registry.QUERIES[key](fx)))
        assert not found, (key, found)


# --- skew ----------------------------------------------------------------------------


def test_hot_group_sends_few_rows_per_task(spark):
    hot = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("handle"),
        F.col("id").cast("string").alias("shortcode"),
        F.lit("2024-01-01").cast("date").alias("post_date"))
    limited = posts.latest_posts(hot)
    assert limited.where("handle = 'hot'").count() == 12
    assert limited.count() == 40_000 + 12


@pytest.fixture
def small_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


N = 60_000


def hot_third(spark):
    """Rows of which a third share the key ``hot``."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id")))
    return spark.range(0, N, 1, 12).withColumns({"key": key, "text_id": F.col("id").cast("string")})


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_handle_candidates_are_split(spark, small_skew_limits):
    base = hot_third(spark)
    candidates = base.select(
        F.col("text_id").alias("artist_id"), F.concat(F.lit("some band "), "text_id").alias("artist_name"),
        F.lit(0).alias("source_ord"), F.lit(0).alias("position"), F.col("key").alias("handle"))
    # one row per handle, straight out of a grouped choice
    profiles = groups.latest_per_key(base.select(
        F.col("key").alias("handle"), F.lit("The Band").alias("full_name"),
        F.lit("").alias("biography"), F.lit(9000).alias("followers"), "id"), ["handle"], ["id"])
    verified = matching.verify_handles(candidates, profiles)
    total = verified.agg(F.count("*"), F.count_distinct("artist_id"))
    assert "skew=true" in executed(total)
    assert total.first() == (N, N)


def test_hot_handle_releases_are_split(spark, small_skew_limits):
    base = hot_third(spark)
    tracks = base.select(
        F.col("text_id").alias("track_id"), F.lit("a").alias("artist_id"),
        F.concat(F.lit("song "), "text_id").alias("track_name"),
        F.lit(None).cast("date").alias("release_date"), F.col("key").alias("instagram_handle"))
    feed = base.select(
        F.col("key").alias("handle"), F.col("text_id").alias("shortcode"),
        F.lit("2024-01-01").cast("date").alias("post_date"), F.col("id").alias("likes"),
        F.col("id").alias("comments"), F.lit("a song").alias("caption"))
    total = songs.release_posts(tracks, feed).agg(
        F.count("*"), F.count("instagram_post_id"), F.max("instagram_post_rank"))
    assert "skew=true" in executed(total)
    assert total.first() == (N, N, 1)


def test_rows_without_a_key_spread_over_partitions(spark, no_broadcast):
    tracks = spark.range(20_000).select(
        F.col("id").cast("string").alias("track_id"), F.lit(None).cast("string").alias("h"))
    keyed = tracks.select(groups.spread_nulls(F.col("h"), F.col("track_id")).alias("k"))
    sizes = keyed.repartition(4, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 6_000
