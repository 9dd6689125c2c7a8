"""What jobs compute or carry twice: arrivals, scored rows, post bins, derived texts, line items."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import plan
from limelight import schemas
from limelight.operators import groups, matching, songs
from limelight.plans import enrichment
from limelight.registry import fixture, queries
from limelight.registry.fixture import AMOUNTS, Fixture
from limelight.streaming.changes import MergedStore


def counted(spark, df):
    """``df`` and a counter of the rows that jobs over it have computed."""
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(tell, df.schema), seen


def of_schema(spark, schema, *some):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in some], schema)


def artist(i, **more):
    at = dt.datetime(2024, 1, 31)
    return {
        "artist_id": f"a{i}", "artist_name": f"n{i}", "lastfm_listeners": 20_000 + i, "lastfm_playcount": 90_000,
        "lastfm_playcount_per_listener": 4.5, "genres": "jazz", "primary_genre": "jazz", "source": "s",
        "lastfm_url": "u", "collection_date": at.date(), "collection_timestamp": at, "last_updated": at, **more,
    }


def test_a_refresh_computes_each_arrived_row_once(spark, tmp_path):
    rows = of_schema(spark, schemas.LISTENING, *[artist(i) for i in range(6)])
    batch, seen = counted(spark, rows)
    store = MergedStore(spark, str(tmp_path / "store"), buckets=2)
    store.refresh(0, {"listening": batch}, dt.datetime(2024, 1, 31))
    assert store.merged().count() == 6
    assert seen.value == 6


def test_the_scored_table_is_computed_once_to_be_clustered(spark):
    raw = of_schema(spark, schemas.RAW, *[artist(
        i, instagram_followers=30_000, instagram_engagement_rate=3.0, instagram_reels_count=0,
        data_quality_score=1.0) for i in range(5)])
    raw, seen = counted(spark, raw)
    queries._clustered(SimpleNamespace(spark=spark, raw=raw))
    assert seen.value == 5


def test_links_of_videos_are_made_after_the_last_join(rows):
    tracks = rows("track_id string, artist_id string", ("t1", "a"), ("t2", "a"))
    search = rows("track_id string, video_id string, search_rank int", ("t1", "v1", 1), ("t1", "v2", 2))
    videos = rows(
        "video_id string, title string, views long, likes long, comments long, published_at string",
        ("v1", "one", 1, 2, 3, "2024-01-02T00:00:00Z"), ("v2", "two", 1, 2, 3, "soon"))
    out = songs.track_video(tracks, search, videos)
    got = {r["track_id"]: (r["youtube_video_id"], r["youtube_url"]) for r in out.collect()}
    assert got == {"t1": ("v1", "https://www.youtube.com/watch?v=v1"), "t2": (None, None)}
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert "watch?v=" not in optimized[optimized.index("Join"):]


POSTS = "handle string, shortcode string, post_date date, likes long, comments long, caption string"


def test_the_posts_of_a_profile_hold_their_caption_once(rows):
    day = dt.date(2024, 1, 2)
    posts = rows(POSTS, ("h", "p1", day, 1, 2, "My Long SONG " + "x" * 300), ("h", "p2", day, 1, 2, None))
    kept = songs._recent_posts_by_handle(posts, 5)
    assert str(kept.schema["recent"].dataType).lower().count("caption") == 1
    tracks = rows("track_id string, track_name string, instagram_handle string, release_date date",
                  ("t1", "song", "h", day), ("t2", "x" * 290, "h", day), ("t3", "absent", "h", None),
                  ("t4", "song", None, day))
    found = {r["track_id"]: r["instagram_caption"] for r in songs.release_posts(tracks, posts).collect()}
    shown = ("My Long SONG " + "x" * 300)[:200]
    assert found == {"t1": shown, "t2": shown, "t3": None, "t4": None}


def test_bins_of_posts_are_counted_once(spark, rows):
    day = dt.date(2024, 1, 2)
    posts, seen = counted(spark, rows(POSTS, *[("h", f"p{i}", day, 1, 2, "song") for i in range(4)]))
    tracks = rows("track_id string, track_name string, instagram_handle string, release_date date",
                  ("t1", "song", "h", day), ("t2", "song", "h", None))
    out = songs.release_posts(tracks, posts, newest=None).collect()
    assert {r["instagram_post_id"] for r in out} == {"p0"}
    assert seen.value <= 8  # once for the bins, once for the ranks


@pytest.fixture
def small(spark, rows, tmp_path):
    """Own tables with keys that repeat, are null or lead nowhere."""
    stamp = dt.datetime(2020, 1, 2)
    tables = {
        "nation": rows("n_nationkey int, n_name string, n_regionkey int", (0, "NATION_0", 1), (1, "N1", None)),
        "customer": rows(
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
            (1, "Customer#000000001", 0, 9000.0, "BUILDING"), (2, "Customer#000000002", 1, 800.0, None),
            (2, "Customer#000000002", 0, 80.0, "HOUSEHOLD"), (None, "Customer#000000009", 0, 1.0, "X")),
        "orders": rows(
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
            (1, 1, "O", 10.0, stamp), (2, 2, "F", 20.0, stamp), (2, 2, "F", 20.0, stamp),
            (3, None, "P", 5.0, stamp), (4, 77, "O", 5.0, stamp)),
        "lineitem": rows(
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            *[(o, p, 3, n, 5.0, 123.45 * n, f, "F", s) for o, p, n, f, s in [
                (1, 1, 1, "A", stamp), (1, 2, 2, "R", None), (2, 9, 1, "N", stamp), (2, 1, 2, None, stamp),
                (3, 1, 1, "A", stamp), (4, 1, 1, "A", stamp), (None, 1, 1, "A", stamp)]]),
        "part": rows("p_partkey long, p_name string", (1, "Red Ring"), (1, "Blue Bolt"), (2, None)),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Fixture(spark, str(tmp_path))


@pytest.mark.parametrize("cluster", [True, False])
def test_kept_line_items_give_the_same_rows_without_a_further_join(small, cluster):
    kept = small.kept(cluster)
    for name in ("uploads", "posts", "videos", "channels", "channel_search", "video_search", "social", "video"):
        was, now = getattr(small, name), getattr(kept, name).select(*getattr(small, name).columns)
        assert sorted(map(str, now.collect())) == sorted(map(str, was.collect())), name
        assert was.columns == getattr(kept, name).columns
    assert small.videos.count() > 0
    assert "l_orderkey" in plan(kept.videos) and "o_orderkey" not in plan(kept.videos)


def test_stored_tables_and_handles_give_the_same_rows(small):
    stored = small.stored("listening", "social")
    for name in ("listening", "social"):
        assert sorted(map(str, getattr(stored, name).collect())) == sorted(map(str, getattr(small, name).collect()))
    handles = small.social.select("artist_id", "instagram_handle")
    assert sorted(map(str, small.social_handles.collect())) == sorted(map(str, handles.collect()))


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_that_no_social_row_needs_end_at_the_first_join(small):
    text = optimized(small.social)
    assert "LeftSemi" in text
    ranked = text[text.index("Window"):]
    assert "l_extendedprice" not in ranked[:ranked.index("Join Inner")]
    assert {r["instagram_handle"] for r in small.social.collect()} == {"artist1", "artist2"}
    totals = optimized(small.video)
    assert "floor" in totals.lower()[totals.lower().rindex("join"):]  # below the join


def test_sums_move_without_a_join_with_the_batch(spark, tmp_path, monkeypatch):
    at = dt.datetime(2024, 1, 31)
    more = {"instagram_followers": 30_000, "instagram_engagement_rate": 3.0, "instagram_reels_count": 0}
    social = of_schema(spark, schemas.SOCIAL, *[{"artist_id": f"a{i}", **more} for i in range(6)])
    listening = [artist(i) for i in range(6)]
    store = MergedStore(spark, str(tmp_path / "store"), buckets=2)
    plans, facts = [], MergedStore._facts
    monkeypatch.setattr(MergedStore, "_facts", lambda s, rows, sign: (
        plans.append(plan(rows)), facts(s, rows, sign))[1])
    store.refresh(0, {
        "listening": of_schema(spark, schemas.LISTENING, *listening),
        "social": social.withColumn("collection_timestamp", F.lit(at))}, at)
    # one artist changes, its bucket's others do not
    store.refresh(1, {"listening": of_schema(spark, schemas.LISTENING, artist(0, primary_genre="soul"))}, at)
    counts = {r["key"]: r["rows"] for r in store.summary().where("kind = 'genre'").collect()}
    want = {r["primary_genre"]: r["count"] for r in store.scored().groupBy("primary_genre").count().collect()}
    assert counts == want == {"jazz": 5, "soul": 1}
    sums = store.summary().where("kind = 'growth'").groupBy().sum("sum_lastfm_listeners").first()[0]
    assert sums == sum(20_000 + i for i in range(6))
    assert len(plans) == 4 and not any("Join" in p for p in plans)


def test_handles_are_sought_with_the_amounts_that_are_read(small):
    slim, full = small.kept(amounts=["views"]), small.kept()
    assert not {"l_extendedprice", "l_quantity", "likes"} & set(slim.lines.columns)
    assert "likes" not in slim.videos.columns and "views" in slim.videos.columns
    for name in ("channels", "channel_search"):
        assert sorted(map(str, getattr(slim, name).collect())) == sorted(map(str, getattr(full, name).collect()))


def test_only_texts_of_chosen_channels_are_grouped(rows):
    artists = rows("artist_id string, artist_name string", ("a", "One"), ("b", "Two"))
    search = rows("artist_id string, channel_id string, search_rank long",
                  ("a", "c1", 1), ("a", "c2", 2), ("b", None, 1))
    channels = rows("channel_id string, description string, subscribers long", ("c1", "x", 5), ("c2", "y", 9))
    videos = rows("channel_id string, video_id string, published_at string, description string",
                  ("c1", "v1", "2024", "ig: handle_of_c1"), ("c2", "v2", "2024", "ig: handle_of_c2"),
                  (None, "v3", "2024", "ig: handle_of_none"))
    found = matching.handle_candidates(artists, search, channels, videos)
    assert "LeftSemi" in optimized(found)
    got = {(r["artist_id"], r["handle"]) for r in found.where("source_ord = 1").collect()}
    assert got == {("a", "handle_of_c2")}


def test_more_keys_than_are_broadcast_are_met_by_a_filter(spark):
    df = spark.range(20_000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("key"), "id")
    wanted = spark.range(4_000).select(F.when(F.col("id") > 9, F.concat(F.lit("k"), F.col("id") % 2000)).alias("w"))
    left = groups.only_wanted(df, wanted, "key", "w", most=100)
    assert left.columns == df.columns
    got = {r["id"] for r in left.collect()}
    assert set(range(1, 2000)) <= got and 0 not in got
    assert len(got) < 1999 + 0.1 * 18_000
    assert groups.only_wanted(df, wanted, "key", "w", most=100, most_filtered=200).count() == 20_000
    assert groups.only_wanted(df, wanted, "key", "w").count() == 1999


def test_titles_of_kept_lines_are_joined_once(small):
    kept = small.kept(cluster=False, amounts=AMOUNTS, titled=True)
    for name in ("posts", "videos", "video_search", "social_handles"):
        now = getattr(kept, name)
        was = getattr(small, name).select(*now.columns)
        assert sorted(map(str, now.collect())) == sorted(map(str, was.collect())), name
    assert any(r["title"] is None for r in small.videos.collect())
    assert "Join" not in optimized(kept.posts) and "Join" not in optimized(kept.videos)
    assert not {"l_returnflag", "l_linestatus", "l_extendedprice"} & set(kept.lines.columns)


def test_only_posts_near_a_release_are_folded(rows):
    day = dt.date(2024, 3, 1)
    posts = rows(POSTS, *[("h", f"p{i}", day - dt.timedelta(days=i), 1, 2, "song") for i in range(6)],
                 ("h", "undated", None, 1, 2, "song"), ("other", "p9", day, 1, 2, "song"))
    tracks = rows("track_id string, track_name string, instagram_handle string, release_date date",
                  ("t1", "song", "h", day - dt.timedelta(days=3)), ("t2", "song", "h", day - dt.timedelta(days=3)),
                  ("t3", "song", None, None))
    kept = songs._recent_posts_by_handle(posts, 5, tracks, 1).collect()
    assert {r["handle"]: [(p["instagram_post_rank"], p["instagram_post_id"]) for p in r["recent"]] for r in kept} == {
        "h": [(3, "p2"), (4, "p3"), (5, "p4")]}
    found = songs.release_posts(tracks, posts, 5, 1, dated=True).collect()
    assert {r["track_id"]: r["instagram_post_id"] for r in found} == {"t1": "p2", "t2": "p2", "t3": None}


def test_videos_that_no_track_found_are_not_moved(rows, monkeypatch):
    most = groups.only_wanted
    monkeypatch.setattr(songs, "only_wanted", lambda *a: most(*a, most=0))
    videos = rows("video_id string, title string, views long, likes long, comments long, published_at string",
                  *[(f"v{i}", "t", i, 0, 0, "2024-01-02") for i in range(50)], (None, "t", 0, 0, 0, None))
    out = songs.track_video(rows("track_id string", ("a",), ("b",), (None,)), rows(
        "track_id string, video_id string, search_rank int", ("a", "v3", 1), ("a", "v4", 2), ("b", None, 1)), videos)
    assert {r["track_id"]: r["youtube_views"] for r in out.collect()} == {"a": 3, "b": None, None: None}
    assert "LeftSemi" in optimized(out)


def test_the_catalogue_reads_titled_lines(small, monkeypatch):
    stored, keep = {}, fixture.stored_once
    monkeypatch.setattr(fixture, "stored_once", lambda df, label, *more: (
        stored.update({label: df.columns}), keep(df, label, *more))[1])
    got = queries.song_catalogue(small)
    want = enrichment.song_catalogue(
        small.listening, small.social_handles, small.chart.drop("artist_name", "instagram_handle"),
        small.video_search, small.videos, small.posts, queries.BATCH_DATE)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    assert "parts" in stored["lines"] and "l_returnflag" not in stored["lines"]


@pytest.mark.parametrize("most", [1, 3, 2000])
def test_all_posts_of_handles_of_any_size_are_searched(rows, most):
    day = dt.date(2024, 3, 1)
    some = [(h, f"p{i % 7}{i}", day - dt.timedelta(days=11 * i) if i % 5 else None, i, 2, f"song{i % 4} x" if i % 6 else None)
            for h, n in (("a", 30), ("b", 3), ("c", 1), (None, 4)) for i in range(n)]
    posts = rows(POSTS, *some, some[1])
    asked = [(f"t{h}{i}{j}", f"song{i}", h, d) for h in ("a", "b", "c", "none", None) for i in range(5)
             for j, d in enumerate((None, day, day - dt.timedelta(days=200)))]
    tracks = rows("track_id string, track_name string, instagram_handle string, release_date date", *asked)
    got = {r["track_id"]: (r["instagram_post_rank"], r["instagram_post_id"])
           for r in songs._release_posts_of_all(tracks, posts, 30, most).collect()}
    want = {}
    for track, title, handle, release in asked:
        mine = sorted((p for p in [*some, some[1]] if handle and p[0] == handle),
                      key=lambda p: (-(p[2] or dt.date.min).toordinal(), p[1]))
        fits = [(n, p[1]) for n, p in enumerate(mine, 1) if title in (p[5] or "") and (
            release is None or p[2] is not None and abs((p[2] - release).days) <= 30)]
        want[track] = fits[0] if fits else (None, None)
    assert got == want


def test_tracks_visit_no_bins_of_handles_with_few_posts(rows):
    day = dt.date(2024, 1, 2)
    posts = rows(POSTS, *[("h", f"p{i}", day - dt.timedelta(days=90 * i), 1, 2, "song") for i in range(4)])
    tracks = rows("track_id string, track_name string, instagram_handle string, release_date date",
                  ("t1", "song", "h", day), ("t2", "song", "h", None))
    out = songs.release_posts(tracks, posts, newest=None)
    assert {r["track_id"]: r["instagram_post_rank"] for r in out.collect()} == {"t1": 1, "t2": 1}
    assert "explode" not in optimized(out) and "Union" not in optimized(out)
