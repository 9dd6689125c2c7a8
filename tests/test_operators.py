"""Filters, joins, grouped choices, aggregates and distributions on hand-made rows."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import values
from limelight import schemas
from limelight.operators import (
    discovery, distribution, filters, groups, matching, merge, posts, songs, videos,
)
from limelight.plans import reports
from limelight.plans.view import ArtistView

DAY = dt.date(2024, 1, 31)
AT = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


# --- filters -------------------------------------------------------------------------


def test_emerging_bounds(rows):
    df = rows("lastfm_listeners BIGINT", (4999,), (5000,), (200000,), (200001,), (None,))
    assert values(filters.emerging_filter(df)) == [200000, 5000]


def test_exclude_established_ignores_case_and_keeps_null(rows):
    df = rows("artist_name STRING", ("ColdPlay",), ("the rolling stones",), (None,), ("Adele ",))
    assert values(filters.exclude_established(df)) == ["Adele ", None, "the rolling stones"]
    assert filters.exclude_established(df, []).count() == 4


def test_dashboard_filters(rows):
    df = rows(
        "artist_id STRING, growth_potential STRING, primary_genre STRING, "
        "instagram_followers BIGINT, instagram_engagement_rate DOUBLE",
        ("a", "High", "soul", 10, 1.0), ("b", "Low", "jazz", 20, 2.0),
        ("c", "High", "folk", None, None), ("d", None, None, 30, 3.0), ("e", "Medium", "blues", 5, 9.0),
    )
    ids = lambda d: values(d, "artist_id")
    assert ids(filters.by_growth(df, "High Potential")) == ["a", "c"]
    assert ids(filters.by_growth(df)) == list("abcde")
    assert ids(filters.by_genre(df)) == ["b", "c", "e"]       # blues, folk, jazz
    assert ids(filters.by_genre(df, [])) == list("abcde")
    assert ids(filters.by_genre(df, ["soul"])) == ["a"]
    assert ids(filters.by_follower_range(df, 10, 20)) == ["a", "b", "c"]
    assert ids(filters.by_follower_range(df)) == list("abcde")
    assert ids(filters.by_engagement(df)) == list("abcde")
    assert ids(filters.by_engagement(df, 2.0)) == ["b", "d", "e"]
    view = ArtistView(df).by_growth("High Potential").by_genre().by_followers(10)
    assert ids(view.frame) == ["a", "c"]


def test_complete_and_ratio(rows):
    df = rows("artist_id STRING, instagram_followers BIGINT, youtube_subscribers BIGINT, "
              "lastfm_listeners BIGINT, underrated_ratio DOUBLE",
              ("a", 1, 1, 1, 0.0), ("b", None, 1, 1, None), ("c", 1, None, 1, 2.0))
    assert values(filters.complete_artists(df), "artist_id") == ["a"]
    assert values(filters.with_ratio(df), "artist_id") == ["a", "c"]


# --- grouped choices -----------------------------------------------------------------


def test_first_hit_keeps_query_order(rows):
    df = rows("artist_name STRING, source STRING, search_ord INT, query_ord BIGINT, hit_ord INT",
              ("x", "later tag", 1, 0, 0), ("x", "first tag", 0, 3, 9),
              ("x", "first tag", 0, 3, 2), ("y", "only", 4, 5, 5))
    assert values(groups.first_hit_per_artist(df), "artist_name", "source", "hit_ord") == [
        ("x", "first tag", 2), ("y", "only", 5)]
    # the chart is asked last, whatever its page numbers
    chart = rows("artist_name STRING, source STRING, search_ord INT, query_ord BIGINT, hit_ord INT",
                 ("y", "uk_top", 15, 0, 0), ("z", "uk_top", 15, 0, 1))
    both = discovery.discover(df, chart)
    assert values(both, "artist_name", "source") == [
        ("x", "first tag"), ("y", "only"), ("z", "uk_top")]


def test_ties_do_not_depend_on_files(rows):
    schema = "artist_id STRING, collection_timestamp INT, v STRING, m MAP<STRING, INT>"
    data = [("a", 1, f"v{i}", {"k": i}) for i in range(20)] + [("b", 1, "x", None)]
    picks = set()
    for parts in (1, 3, 7):
        for order in (data, data[::-1]):
            out = groups.latest_per_artist(rows(schema, *order).repartition(parts))
            picks.add(tuple(values(out, "artist_id", "v")))
    assert len(picks) == 1


def test_append_keeps_newest_and_is_idempotent(rows):
    schema = "artist_id STRING, t INT, v STRING"
    old = rows(schema, ("a", 1, "old"), ("b", 5, "kept"), ("c", 1, "gone"))
    new = rows(schema, ("a", 2, "new"), ("b", 4, "late"), ("c", 1, "tie"), ("d", 1, "first"))
    once = groups.append_batch(old, new, ["artist_id"], ["t"])
    expected = [("a", 2, "new"), ("b", 5, "kept"), ("c", 1, "tie"), ("d", 1, "first")]
    assert values(once) == expected
    assert values(groups.append_batch(once, new, ["artist_id"], ["t"])) == expected
    assert values(groups.latest_per_key(once, ["artist_id"], ["t"])) == expected


def test_append_fills_missing_columns(rows):
    out = groups.append_batch(rows("artist_id STRING, t INT, v STRING", ("a", 1, "x")),
                              rows("artist_id STRING, t INT", ("b", 1)), ["artist_id"], ["t"])
    assert values(out, "artist_id", "v") == [("a", "x"), ("b", None)]


# --- merge ---------------------------------------------------------------------------


def source(spark, schema, **row):
    return spark.createDataFrame([tuple(row.get(n) for n in schemas.names(schema))], schema)


def test_merge_keeps_every_listening_row(spark, rows):
    listening = source(spark, schemas.LISTENING, artist_id="a", artist_name="A", lastfm_listeners=5)
    listening = listening.unionByName(
        source(spark, schemas.LISTENING, artist_id="b", artist_name="B"))
    social = source(spark, schemas.SOCIAL, artist_id="a", artist_name="other", instagram_followers=9)
    video = spark.createDataFrame([], schemas.VIDEO)
    out = merge.merge_sources(listening, social, video, AT)
    assert out.schema.names == schemas.names(schemas.RAW)
    assert values(out, "artist_id", "artist_name", "instagram_followers", "youtube_subscribers",
                  "data_quality_score") == [("a", "A", 9, None, 0.7), ("b", "B", None, None, 0.0)]
    assert {r.collection_date for r in out.collect()} == {DAY}


def test_duplicate_source_rows_fan_out_unless_reduced(spark):
    listening = source(spark, schemas.LISTENING, artist_id="a", artist_name="A")
    one = source(spark, schemas.SOCIAL, artist_id="a", instagram_followers=1, instagram_posts=1)
    two = source(spark, schemas.SOCIAL, artist_id="a", instagram_followers=2, instagram_posts=2)
    social, video = one.unionByName(two), spark.createDataFrame([], schemas.VIDEO)
    assert merge.merge_sources(listening, social, video, AT).count() == 2
    reduced = groups.latest_per_artist(social, ["instagram_posts"])
    out = merge.merge_sources(listening, reduced, video, AT)
    assert values(out, "instagram_followers") == [2]


def test_attach_handles(rows):
    out = merge.attach_handles(rows("artist_id STRING, artist_name STRING", ("a", "A"), ("b", "B")),
                               rows("artist_id STRING, instagram_handle STRING, x INT", ("a", "h", 1)))
    assert values(out) == [("a", "A", "h"), ("b", "B", None)]


# --- matching ------------------------------------------------------------------------

CHANNELS = ("channel_id STRING, title STRING, description STRING, subscribers BIGINT, "
            "views BIGINT, videos BIGINT")


def test_channel_choice(rows):
    artists = rows("artist_id STRING, artist_name STRING", ("a", "Bjork"), ("b", "Zed Moon"),
                   ("c", "Nobody"))
    search = rows("artist_id STRING, channel_id STRING, search_rank BIGINT",
                  ("a", "c1", 1), ("a", "c2", 2), ("a", "c3", 3), ("b", "c2", 1), ("b", "c4", 2),
                  ("c", "c5", 1), ("c", "c1", 11))
    channels = rows(CHANNELS,
                    ("c1", "Bjork", "", 600, 1, 1), ("c2", "Bjork", "bjork", 700, 1, 1),
                    ("c3", "Bjork Official", "", 499, 1, 1), ("c4", "Moon", "", 500001, 1, 1),
                    ("c5", "plain", "nobody here", 9000, 1, 1))
    found = matching.artist_channel_candidates(artists, search, channels)
    assert values(found, "artist_id", "channel_id", "match_score") == [
        ("a", "c1", 6), ("a", "c2", 8), ("b", "c2", 1), ("b", "c4", 5), ("c", "c5", 3)]
    best = matching.best_channel(found)
    assert values(best, "artist_id", "channel_id") == [("a", "c2"), ("b", "c4")]
    assert values(filters.channel_size_filter(best), "artist_id") == ["a"]
    assert values(matching.largest_channel(search, channels), "artist_id", "channel_id") == [
        ("a", "c2"), ("b", "c4"), ("c", "c5")]


def test_equal_channels_go_to_the_earlier_result(rows):
    found = rows("artist_id STRING, channel_id STRING, search_rank BIGINT, subscribers BIGINT, "
                 "match_score INT", ("a", "z", 1, 600, 6), ("a", "b", 2, 600, 6))
    assert values(matching.best_channel(found), "channel_id") == ["z"]


def test_resolve_order(rows):
    artists = rows("artist_id STRING, artist_name STRING", ("a", "Ann Lee"), ("b", "Bo Ray"),
                   ("c", "The Cats"), ("d", "Dee"))
    search = rows("artist_id STRING, channel_id STRING, search_rank BIGINT",
                  ("a", "ca", 1), ("b", "cb", 1))
    channels = rows(CHANNELS, ("ca", "t", "@small @annlee @later", 600, 1, 1),
                    ("cb", "t", "@stranger", 600, 1, 1))
    vids = rows("channel_id STRING, video_id STRING, published_at STRING, description STRING",
                *[("cb", f"v{i}", f"2024-01-0{i}", f"@bo{i}") for i in range(1, 8)])
    profiles = rows("handle STRING, full_name STRING, biography STRING, followers BIGINT",
                    ("small", "ann lee", "", 4999), ("annlee", "Ann Lee", "", 5000),
                    ("later", "ann lee", "", 9000), ("stranger", "nn", "nn", 9000),
                    ("bo2", "ray", "", 9000), ("bo3", "ray", "", 9000), ("bo5", "ray", "", 9000),
                    ("thecats", "x", "y", 9000), ("cats", "x", "the cats", 9000),
                    ("thecatsmusic", "cats", "", 9000))
    found = matching.handle_candidates(artists, search, channels, vids)
    # newest five videos only: v7..v3, so the first verified one is v5
    assert values(matching.resolve_handle(found, profiles), "artist_id", "handle") == [
        ("a", "annlee"), ("b", "bo5"), ("c", "cats")]
    tried = found.where("artist_id = 'd'")
    assert values(tried, "source_ord", "position", "handle") == [
        (6, 0, "dee"), (6, 1, "dee"), (6, 2, "deemusic"), (6, 3, "deeofficial")]
    assert values(matching.existing_profiles(found, profiles).where("artist_id = 'c'"), "handle") \
        == ["cats", "thecats", "thecatsmusic"]


# --- posts and videos ----------------------------------------------------------------

POSTS = ("handle STRING, shortcode STRING, post_date DATE, likes BIGINT, comments BIGINT, "
         "is_video BOOLEAN, caption STRING")


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_post_engagement(rows):
    feed = [("h", f"s{i:02}", day(i), 100 + i, i, i % 2 == 0, "") for i in range(13)]
    feed.append(("tiny", "s", day(1), 1, 1, True, ""))
    profiles = rows("handle STRING, full_name STRING, biography STRING, followers BIGINT, "
                    "followees BIGINT, mediacount BIGINT, is_verified BOOLEAN",
                    ("h", "", "", 7000, 1, 2, True), ("tiny", "", "", 4999, 1, 2, False),
                    ("silent", "", "", 9000, 1, 2, False))
    out = posts.post_engagement(rows(POSTS, *feed), profiles).collect()
    likes, comments = sum(range(101, 113)) / 12, sum(range(1, 13)) / 12
    assert [tuple(r) for r in out] == [(
        "h", 7000, 1, 2, round(likes, 2), round(comments, 2),
        round((likes + comments) / 7000 * 100, 2), 6, True)]


def test_zero_followers_give_zero_rate(rows):
    profiles = rows("handle STRING, followers BIGINT, followees BIGINT, mediacount BIGINT, "
                    "is_verified BOOLEAN", ("h", 0, 0, 0, False))
    out = posts.post_engagement(rows(POSTS, ("h", "s", day(0), 5, 5, False, "")), profiles, 0)
    assert values(out, "instagram_engagement_rate") == [0.0]


def test_recent_video_mean(rows):
    feed = [("c", f"v{i:02}", f"2024-01-{i:02}T00:00:00Z", 10 * i) for i in range(1, 13)]
    feed.append(("d", "v", "2024-01-01T00:00:00Z", 5))
    vids = rows("channel_id STRING, video_id STRING, published_at STRING, views BIGINT", *feed)
    assert values(videos.recent_video_mean(vids)) == [("c", 75.0), ("d", 5.0)]
    stats = videos.channel_stats(rows(CHANNELS, ("c", "", "", 500, 9, 2), ("e", "", "", 500000, 7, 2),
                                      ("f", "", "", 499, 1, 1), ("g", "", "", 500001, 1, 1)))
    assert values(stats, "youtube_channel_id", "youtube_avg_views_per_video") == [
        ("c", 4.0), ("e", 4.0)]
    assert values(videos.with_recent_mean(stats, vids), "youtube_channel_id",
                  "youtube_avg_views_per_video") == [("c", 75.0), ("e", 0.0)]


# --- songs ---------------------------------------------------------------------------

TRACKS = ("track_id STRING, artist_id STRING, artist_name STRING, track_name STRING, "
          "release_date DATE, instagram_handle STRING")


def test_release_window_and_newest_match(rows):
    feed = rows(POSTS, ("h", "p0", day(0), 1, 1, False, "Blue Bolt out"),
                ("h", "p30", day(30), 2, 2, False, "BOLT again"),
                ("h", "p31", day(31), 3, 3, False, "blue bolt"),
                ("g", "q", day(0), 4, 4, False, None))
    tracks = rows(TRACKS, ("t1", "a", "A", "Blue Bolt", day(0), "h"),
                  ("t2", "a", "A", "Blue Bolt", None, "h"),
                  ("t3", "a", "A", "Other Thing", day(0), "h"),
                  ("t4", "a", "A", "Blue Bolt", day(-30), "h"),
                  ("t5", "a", "A", "Blue Bolt", day(-31), "h"),
                  ("t6", "b", "B", "Blue Bolt", day(0), None),
                  ("t7", "b", "B", "Blue Bolt", day(0), "g"))
    out = songs.release_posts(tracks, feed)
    assert values(out, "track_id", "instagram_post_id") == [
        ("t1", "p30"), ("t2", "p31"), ("t3", None), ("t4", "p0"), ("t5", None), ("t6", None),
        ("t7", None)]
    assert values(songs.first_matching_post(tracks, feed), "track_id", "instagram_post_rank") == [
        ("t1", 2), ("t2", 1), ("t4", 3)]


def test_only_the_newest_posts_are_searched(rows):
    feed = [("h", f"s{i:02}", day(i), 0, 0, False, "hit single" if i == 0 else "") for i in range(51)]
    tracks = rows(TRACKS, ("t", "a", "A", "Single", None, "h"))
    assert values(songs.release_posts(tracks, rows(POSTS, *feed)), "instagram_post_id") == [None]
    assert values(songs.release_posts(tracks, rows(POSTS, *feed[:50])), "instagram_post_id") == ["s00"]


def brute_force_release(tracks, feed, newest=50, window=30):
    found = {}
    for track_id, _, _, title, release, handle in tracks:
        own = sorted((p for p in feed if p[0] == handle), key=lambda p: (-p[2].toordinal(), p[1]))
        for p in own[:newest]:
            caption = (p[6] or "").lower()
            said = title.lower() in caption or any(
                w in caption for w in title.lower().split() if len(w) > 3)
            if said and (release is None or abs((p[2] - release).days) <= window):
                found[track_id] = p[1]
                break
    return found


def test_release_posts_equal_brute_force_with_a_hot_artist(rows):
    rng = random.Random(5)
    vocabulary = ["blue", "red", "ox", "bolt", "door", "the", "moonlight", "sun"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    feed = [("hot" if i % 3 == 0 else f"h{rng.randrange(40)}", f"p{i:04}", day(rng.randrange(400)),
             i, i, False, text(2) if rng.random() < 0.9 else None) for i in range(3000)]
    tracks = [(f"t{i}", "a", "A", text(2), None if i % 5 == 0 else day(rng.randrange(400)),
               None if i % 7 == 0 else ("hot" if i % 2 else f"h{rng.randrange(40)}"))
              for i in range(600)]
    out = songs.release_posts(rows(TRACKS, *tracks), rows(POSTS, *feed)).collect()
    assert len(out) == len(tracks)
    assert {r.track_id: r.instagram_post_id for r in out if r.instagram_post_id} \
        == brute_force_release(tracks, feed)


def test_track_video_takes_only_the_top_result(rows):
    tracks = rows("track_id STRING, artist_id STRING", ("t1", "a"), ("t2", "a"), ("t3", "a"))
    search = rows("track_id STRING, video_id STRING, search_rank INT",
                  ("t1", "v1", 2), ("t1", "v2", 1), ("t2", "lost", 1), ("t2", "v1", 2))
    vids = rows("video_id STRING, title STRING, views BIGINT, likes BIGINT, comments BIGINT, "
                "published_at STRING", ("v1", "x", 1, 1, 1, "bad"),
                ("v2", "y", 2, 2, 2, "2024-05-01T10:00:00Z"))
    out = songs.track_video(tracks, search, vids)
    assert values(out, "track_id", "youtube_video_id", "youtube_views") == [
        ("t1", "v2", 2), ("t2", None, None), ("t3", None, None)]


def test_song_rows_look_up_posts_of_dated_videos_only(rows):
    charted = rows(
        "track_id STRING, artist_id STRING, artist_name STRING, track_name STRING, "
        "lastfm_playcount BIGINT, lastfm_listeners BIGINT, lastfm_url STRING, lastfm_rank INT, "
        "instagram_handle STRING",
        ("t1", "a", "A", "Blue Bolt", 1, 1, "", 1, "@h"), ("t2", "a", "A", "Blue Bolt", 1, 1, "", 2, "h"))
    search = rows("track_id STRING, video_id STRING, search_rank INT", ("t1", "v1", 1), ("t2", "v2", 1))
    vids = rows("video_id STRING, title STRING, views BIGINT, likes BIGINT, comments BIGINT, "
                "published_at STRING", ("v1", "x", 1, 1, 1, "2024-01-02T00:00:00Z"),
                ("v2", "x", 1, 1, 1, "unknown"))
    feed = rows(POSTS, ("h", "p", day(0), 1, 1, False, "blue bolt"))
    out = songs.song_records(charted, search, vids, feed, DAY)
    assert out.schema.names == schemas.names(schemas.SONG)
    assert values(out, "youtube_video_id", "instagram_post_id") == [("v1", "p"), ("v2", None)]


def test_top_tracks(rows):
    chart = rows("artist_id STRING, track_id STRING, lastfm_rank INT",
                 *[("a", f"t{i:02}", i) for i in range(15)], ("b", "t", 3))
    out = songs.top_tracks(chart)
    assert values(out, "artist_id", "lastfm_rank") == sorted(
        [("a", i) for i in range(10)] + [("b", 3)], key=str)


# --- reports -------------------------------------------------------------------------


def test_null_keys(rows):
    df = rows("artist_name STRING, primary_genre STRING, growth_potential STRING, "
              "priority_score DOUBLE, underrated_ratio DOUBLE, engagement_score DOUBLE, "
              "instagram_followers BIGINT, lastfm_listeners BIGINT",
              ("a", "soul", "High", 1.0, 1.0, 1.0, 1, 1), ("b", None, None, 2.0, None, None, 1, 1),
              (None, "soul", "High", None, 3.0, 1.0, 1, 1))
    assert values(reports.genre_summary(df), "primary_genre", "artist_count", "high_growth_count") == [
        ("soul", 2, 2), (None, 1, 0)]
    assert values(reports.genre_counts(df)) == [("soul", 2)]
    assert values(reports.growth_summary(df)) == [("High", 1, 1.0, 2.0)]
    assert values(reports.overview_metrics(df)) == [(3, 2, 2)]
    assert values(reports.overview_metrics(df.limit(0))) == [(0, 0, 0)]


def scored_rows(rows, *data):
    return rows("artist_id STRING, artist_name STRING, priority_score DOUBLE, "
                "instagram_followers BIGINT, youtube_subscribers BIGINT, lastfm_listeners BIGINT, "
                "lastfm_playcount BIGINT, instagram_engagement_rate DOUBLE, "
                "youtube_total_views BIGINT", *data)


def test_default_artist_and_detail(rows):
    df = scored_rows(rows, ("1", "top", 9.0, None, 1, 1, 1, None, 1),
                     ("2", "full", 5.0, 1, 1, 1, 1, 0.5, 1), ("3", "less", 4.0, 1, 1, 1, 1, 2.0, 1),
                     ("4", "none", None, 1, 1, 1, 1, 2.0, 1))
    assert values(reports.default_artist(df), "artist_name") == ["full"]
    partial = df.where("artist_id = '1'")
    assert values(reports.default_artist(partial), "artist_name") == ["top"]
    assert values(reports.artist_detail(df, "less"), "artist_name", "engagement") == [("less", "2.00%")]
    assert values(reports.artist_detail(df, "absent"), "artist_name", "engagement") == [("top", "N/A")]
    ranked = reports.top3_flag(reports.display_rank(df, 4))
    assert values(ranked, "rank", "artist_id", "highlighted") == [
        (1, "1", True), (2, "2", True), (3, "3", True), (4, "4", False)]


@pytest.mark.parametrize("ranges", [1, 2, 7, 256])
def test_full_rank_equals_a_sort(rows, ranges):
    rng = random.Random(ranges)
    data = [(f"id{i:04}", rng.choice([None, 1.5, 1.5, rng.uniform(-5, 5)])) for i in range(1500)]
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))
    out = reports.full_rank(rows("artist_id STRING, priority_score DOUBLE", *data), ranges)
    got = sorted(out.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, len(data) + 1))
    assert [r.artist_id for r in got] == [r[0] for r in want]


def budget_loop(attempts, stop=9000):
    """The collection loop, one attempt after another."""
    kept, spent = [], 0
    for ordinal, matched, accepted in attempts:
        kept.append(ordinal)
        spent += 100
        if matched:
            spent += 1
            if not accepted:
                continue
            spent += 2
        if spent > stop:
            break
    return kept


@pytest.mark.parametrize("seed, matched_share, accepted_share", [
    (1, 0.0, 0.0), (2, 1.0, 1.0), (3, 1.0, 0.0), (4, 0.6, 0.5), (5, 1.0, 0.02), (6, 0.9, 0.1)])
def test_quota_prefix_equals_the_loop(rows, seed, matched_share, accepted_share):
    rng = random.Random(seed)
    days = {day(0): 400, day(1): 90, day(2): 91, day(3): 5}
    data, expected = [], set()
    for d, n in days.items():
        tried = []
        for i in range(n):
            matched = rng.random() < matched_share
            tried.append((i, matched, matched and rng.random() < accepted_share))
        data += [(d, i, f"a{i}", m, a) for i, m, a in tried]
        expected |= {(d, i) for i in budget_loop(tried)}
    df = rows("collection_date DATE, attempt_ord BIGINT, artist_id STRING, matched BOOLEAN, "
              "accepted BOOLEAN", *data)
    out = reports.quota_prefix(df).collect()
    assert {(r.collection_date, r.attempt_ord) for r in out} == expected
    assert len(out) == len(expected)


@pytest.mark.parametrize("seed", [7, 8])
def test_any_budget_is_summed_up_in_ranges(rows, spark, seed):
    """One day with far more attempts than a range, and a budget that lies deep in it."""
    rng = random.Random(seed)
    data, expected = [], set()
    for d, n, stride in ((day(0), 60_000, 1), (day(1), 300, 7), (day(2), 1, 1)):
        tried = [(i * stride - 50, rng.random() < 0.6, rng.random() < 0.4) for i in range(n)]
        tried = [(i, m, m and a) for i, m, a in tried]
        data += [(d, i, f"a{i}", m, a) for i, m, a in tried]
        expected |= {(d, i) for i in budget_loop(tried, 4_000_000)}
    rng.shuffle(data)
    df = rows("collection_date DATE, attempt_ord BIGINT, artist_id STRING, matched BOOLEAN, "
              "accepted BOOLEAN", *data)
    out = reports.quota_prefix(df, 4_000_000, in_one_task=1000).collect()
    assert {(r.collection_date, r.attempt_ord) for r in out} == expected and len(out) == len(expected)
    assert 300 < len(expected) < len(data)


def test_exact_budget_continues(rows):
    df = rows("collection_date DATE, attempt_ord BIGINT, artist_id STRING, matched BOOLEAN, "
              "accepted BOOLEAN", *[(day(0), i, "a", False, False) for i in range(120)])
    assert reports.quota_prefix(df).count() == 91


def test_release_posts_among_all_posts(rows):
    """A hot handle with more posts than the bounded form looks at, old matches included."""
    rng = random.Random(5)
    words = ["night", "river", "stone", "ash", "go"]
    feed, tracks = [], []
    for i in range(900):
        handle = "hot" if i % 3 else f"h{i % 4}"
        date = None if i % 50 == 0 else day(rng.randrange(900))
        caption = rng.choice([None, " ".join(rng.choices(words, k=2)), "nothing"])
        feed.append((handle, f"s{i:04}", date, i, i, caption))
    for i in range(120):
        release = None if i % 5 == 0 else day(rng.randrange(900))
        handle = rng.choice(["hot", "hot", "h0", "h3", "absent", None])
        tracks.append((f"t{i}", "a", "A", " ".join(rng.choices(words, k=2)).title(), release, handle))
    by_handle = {}
    for p in feed:
        by_handle.setdefault(p[0], []).append(p)
    want = []
    for track_id, _, _, title, release, handle in tracks:
        hit = (None, None)
        newest = sorted(by_handle.get(handle, []), key=lambda p: (
            p[2] is None, -(p[2] or day(0)).toordinal(), p[1]))
        for place, p in enumerate(newest, 1):
            caption = (p[5] or "").lower()
            said = title.lower() in caption or any(
                w in caption for w in title.lower().split() if len(w) > 3)
            near = release is None or p[2] is not None and abs((p[2] - release).days) <= 30
            if said and near:
                hit = (place, p[1])
                break
        want.append((track_id, *hit))
    posts = rows("handle STRING, shortcode STRING, post_date DATE, likes BIGINT, comments BIGINT, "
                 "caption STRING", *feed)
    charted = rows("track_id STRING, artist_id STRING, artist_name STRING, track_name STRING, "
                   "release_date DATE, instagram_handle STRING", *tracks)
    out = songs.release_posts(charted, posts, newest=None)
    assert values(out, "track_id", "instagram_post_rank", "instagram_post_id") == sorted(want, key=str)
    assert any(rank and rank > 50 for _, rank, _ in want)


def test_source_row_counts(rows):
    df = rows("source STRING, batch INT", ("s", 1), ("s", 1), ("s", 3), ("v", 3))
    assert values(reports.source_row_counts(df)) == [
        ("s", 1, 2, None), ("s", 3, 1, -1), ("v", 3, 1, None)]


def test_small_reports(rows):
    df = rows("artist_id STRING, lastfm_listeners BIGINT", ("a", 4999), ("b", 5000), ("c", 150000),
              ("d", 150001))
    assert values(reports.listener_range_stats(df)) == [(4999, 150001, 2, 1, 1)]
    assert values(reports.quota_estimate(df)) == [(4, 404)]
    found = rows("artist_id STRING", ("a",), ("a",), ("z",))
    assert values(reports.success_rate(df, found)) == [(4, 1, 25.0)]
    sides = rows("artist_id STRING, underrated_ratio DOUBLE", ("a", 0.9), ("b", 1.0), ("c", 1.1),
                 ("d", None))
    assert values(reports.ratio_sides(sides), "artist_id", "side") == [
        ("a", "below"), ("b", "equal"), ("c", "above")]
    assert values(distribution.share_above(sides, "underrated_ratio")) == [(3, 1, 1 / 3)]


def test_reports_on_an_empty_table(spark):
    empty = spark.createDataFrame([], schemas.SCORED)
    view = ArtistView(empty)
    assert reports.key_insights(empty).isEmpty()
    assert view.ratios().isEmpty() and view.table().isEmpty() and view.growth().isEmpty()
    assert view.genres().isEmpty() and view.default_artist().isEmpty()
    assert distribution.describe_scores(empty, ["priority_score"]).isEmpty()


def test_genres_are_shown_from_three_on(rows):
    schema = "primary_genre STRING"
    assert ArtistView(rows(schema, ("a",), ("b",), ("b",))).genres().isEmpty()
    assert values(ArtistView(rows(schema, ("a",), ("b",), ("b",), (None,))).genres()) == [
        ("a", 1), ("b", 2)]


# --- distributions -------------------------------------------------------------------


def test_histogram_equals_numpy(rows):
    rng = random.Random(3)
    data = [rng.gauss(0, 5) for _ in range(2000)] + [7.25] * 1000
    out = distribution.histogram(rows("x DOUBLE", *[(v,) for v in data], (None,)), "x", 20).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=20)
    assert [r.artists for r in out] == counts.tolist()
    assert np.allclose([r.lower_edge for r in out], edges[:-1])
    assert np.allclose([r.upper_edge for r in out], edges[1:])


def test_histogram_edge_cases(rows):
    same = distribution.histogram(rows("x DOUBLE", (2.0,), (2.0,)), "x", 4).orderBy("bin").collect()
    assert [r.artists for r in same] == np.histogram([2.0, 2.0], bins=4)[0].tolist()
    top = distribution.histogram(rows("x INT", (0,), (10,)), "x", 5).orderBy("bin").collect()
    assert [r.artists for r in top] == [1, 0, 0, 0, 1]


@pytest.mark.parametrize("kind", ["smooth", "hot", "two", "one", "ties"])
def test_exact_quantiles_equal_numpy(rows, kind):
    rng = random.Random(9)
    data = {
        "smooth": [rng.gauss(0, 1) for _ in range(5000)],
        "hot": [0.5] * 2000 + [rng.random() for _ in range(4000)],
        "two": [1.0, 4.0],
        "one": [3.0],
        "ties": [float(rng.randrange(6)) for _ in range(3001)],
    }[kind]
    df = rows("x DOUBLE, y BIGINT", *[(v, i) for i, v in enumerate(data)], (None, None))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    # a coarse sketch must not change the result
    for margin, accuracy in ((0.002, 1_000), (0.0, 3)):
        out = distribution.exact_quantiles(df, ["x", "y"], probabilities, margin, accuracy).collect()
        got = {(r.metric, r.probability): r.quantile for r in out}
        for p in probabilities:
            assert got["x", p] == pytest.approx(np.quantile(data, p), abs=1e-12)
            assert got["y", p] == pytest.approx(np.quantile(range(len(data)), p))


def test_describe_scores(rows):
    import pandas as pd
    data = [1.5, 2.5, 2.5, 9.0, 4.0]
    out = distribution.describe_scores(rows("x DOUBLE", *[(v,) for v in data], (None,)), ["x"]).first()
    want = pd.Series(data).describe()
    assert [out[c] for c in ("n", "mean", "std", "min", "q25", "q50", "q75", "max")] == \
        pytest.approx(want.tolist())


def test_platform_normalised(rows):
    df = rows("artist_id STRING, artist_name STRING, lastfm_listeners BIGINT, "
              "instagram_followers BIGINT, youtube_subscribers BIGINT",
              ("a", "A", 50, 10, None), ("b", "B", 200, None, None))
    assert values(distribution.platform_normalised(df), "artist_id", "platform", "score") == [
        ("a", "Instagram", 100.0), ("a", "Last.fm", 25.0), ("a", "YouTube", 0.0),
        ("b", "Instagram", 0.0), ("b", "Last.fm", 100.0), ("b", "YouTube", 0.0)]
    assert values(ArtistView(df).comparison("A"), "score") == [0.0, 100.0, 25.0]
