"""Boundary tables of the metric expressions and the scoring rules."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import values
from limelight.config import DOCUMENTED, GENERATED, TABLE
from limelight.functions import metrics
from limelight.functions.numeric import array_round, exact_round
from limelight.operators import filters
from limelight.operators.merge import zero_fill
from limelight.plans.scoring import score, score_zero_filled, scored_artists

RAW = (
    "artist_id STRING, artist_name STRING, primary_genre STRING, collection_date DATE, "
    "lastfm_listeners BIGINT, lastfm_playcount BIGINT, lastfm_playcount_per_listener DOUBLE, "
    "instagram_handle STRING, instagram_followers BIGINT, instagram_following BIGINT, "
    "instagram_posts BIGINT, instagram_engagement_rate DOUBLE, instagram_avg_likes DOUBLE, "
    "instagram_avg_comments DOUBLE, instagram_reels_count BIGINT, instagram_verified BOOLEAN, "
    "youtube_channel_id STRING, youtube_subscribers BIGINT, youtube_total_views BIGINT, "
    "youtube_video_count BIGINT, youtube_avg_views_per_video DOUBLE, data_quality_score DOUBLE"
)
NAMES = [c.split()[0] for c in RAW.split(", ")]
BASE = {
    "artist_name": "a", "primary_genre": "jazz", "lastfm_listeners": 10_000,
    "lastfm_playcount_per_listener": 2.0, "instagram_followers": 20_000,
    "instagram_engagement_rate": 2.0, "youtube_subscribers": 500, "data_quality_score": 1.0,
}


def raw(spark, *overrides: dict):
    data = []
    for i, change in enumerate(overrides):
        row = {"artist_id": str(i), **BASE, **change}
        data.append(tuple(row.get(n) for n in NAMES))
    return spark.createDataFrame(data, RAW)


def admitted(spark, cfg, column, *cases):
    df = raw(spark, *[{column: c} for c in cases])
    kept = set(values(filters.scoring_filter(df, cfg), "artist_id"))
    return [str(i) in kept for i in range(len(cases))]


def test_listener_bounds(spark):
    cases = (4999, 5000, 200000, 200001, None)
    assert admitted(spark, TABLE, "lastfm_listeners", *cases) == [False, True, True, False, False]


def test_follower_bounds_per_profile(spark):
    cases = (999, 1000, 4999, 5000, 100000, 100001, None)
    assert admitted(spark, TABLE, "instagram_followers", *cases) == [
        False, False, False, True, True, False, True]
    for cfg in (GENERATED, DOCUMENTED):
        assert admitted(spark, cfg, "instagram_followers", *cases) == [
            False, True, True, True, True, False, True]


def test_rate_and_quality_bounds(spark):
    assert admitted(spark, TABLE, "instagram_engagement_rate", 1.0, 1.01, None) == [
        False, True, True]
    assert admitted(spark, TABLE, "data_quality_score", 0.29, 0.3, None) == [False, True, False]


def test_genre_is_exact(spark):
    assert admitted(spark, TABLE, "primary_genre", "jazz", "Jazz", "uk jazz", None) == [
        True, False, False, False]
    assert admitted(spark, DOCUMENTED, "primary_genre", "indie folk", "unknown") == [False, False]
    assert admitted(spark, GENERATED, "primary_genre", "indie rock", "unknown") == [False, True]


@pytest.mark.parametrize("cfg, cases, expected", [
    (TABLE, (15000, 15001, 8000, 8001, None), ["Medium", "High", "Low", "Medium", "Low"]),
    (DOCUMENTED, (20000, 20001, 10000, 10001), ["Medium", "High", "Low", "Medium"]),
])
def test_growth_bounds(spark, cfg, cases, expected):
    df = raw(spark, *[{"instagram_followers": c} for c in cases])
    got = df.orderBy("artist_id").select(metrics.growth_potential(cfg)).collect()
    assert [r[0] for r in got] == expected


def test_platform_count(spark):
    triples = ((5000, 10000, 1000), (5001, 10001, 1001), (5001, None, None))
    names = ("lastfm_listeners", "instagram_followers", "youtube_subscribers")
    df = raw(spark, *[dict(zip(names, t)) for t in triples])
    got = df.orderBy("artist_id").select(metrics.platform_count()).collect()
    assert [r[0] for r in got] == [0, 3, 1]


def test_engagement_score_keeps_null(spark):
    df = raw(spark, *[{"instagram_engagement_rate": r} for r in (4.9, 5.0, 7.0, None)])
    got = df.orderBy("artist_id").select(metrics.engagement_score()).collect()
    assert [r[0] for r in got] == [9.8, 10.0, 10.0, None]


def test_ratio_and_priority_nulls(spark):
    df = raw(spark, {"lastfm_listeners": 0}, {"lastfm_listeners": None},
             {"youtube_subscribers": None}, {})
    got = df.orderBy("artist_id").select(
        metrics.underrated_ratio(), metrics.priority_score(), metrics.follower_gap()).collect()
    assert got[0][0] is None and got[1][0] is None
    assert got[0][1] == 20000 * 0.3 + 2.0 * 20000 * 0.4 + 500 * 0.2 + 2.0 * 1000 * 0.1
    assert got[1][1] is None and got[2][1] is None and got[1][2] is None
    assert got[3] == (2.0, (6000.0 + 16000.0 + 100.0 + 200.0) / 10000, 10000)


def test_quality_score(spark):
    df = raw(spark, {}, {"instagram_followers": None, "youtube_subscribers": None},
             {"youtube_subscribers": None})
    got = df.orderBy("artist_id").select(metrics.data_quality_score()).collect()
    assert [r[0] for r in got] == [1.0, 0.3, 0.7]


def test_zero_fill(spark):
    empty = {n: None for n in NAMES if n != "artist_id"}
    row = zero_fill(raw(spark, empty)).first()
    assert row.instagram_verified is False
    assert row.instagram_followers == 0 and row.lastfm_listeners == 0
    assert row.instagram_engagement_rate == 0.0 and row.data_quality_score == 0.0
    assert row.instagram_reels_count is None and row.instagram_handle is None


def test_zero_filled_scores_drop_artists_without_social(spark):
    missing = {"instagram_followers": None, "instagram_engagement_rate": None}
    df = raw(spark, {}, missing)
    assert scored_artists(df).count() == 2
    assert values(score_zero_filled(df), "artist_id") == ["0"]


def test_scored_order_puts_null_scores_last(spark):
    df = raw(spark, {"youtube_subscribers": None}, {"instagram_followers": 30_000}, {})
    assert [r.artist_id for r in scored_artists(df).collect()] == ["1", "2", "0"]
    assert len(score(df).columns) == 22


def test_labels(spark, rows):
    df = rows("i INT, r DOUBLE", (0, 0.5), (1, 1.0), (2, 9.999), (3, 10.0), (4, None),
              (5, 10.25), (6, 10.35), (7, 12.75))
    got = df.orderBy("i").select(metrics.engagement_label(F.col("r"))).collect()
    assert [r[0] for r in got] == [
        "0.500%", "1.00%", "10.00%", "10.0%", "N/A", f"{10.25:.1f}%", f"{10.35:.1f}%",
        f"{12.75:.1f}%"]


def test_artist_and_social_labels(spark):
    df = raw(spark, {"lastfm_listeners": 1234567, "instagram_handle": "h"},
             {"lastfm_listeners": None, "instagram_handle": "h", "instagram_followers": None},
             {"instagram_handle": None})
    got = df.orderBy("artist_id").select(metrics.artist_label(), metrics.social_label()).collect()
    assert [tuple(r) for r in got] == [
        ("a (1,234,567 Last.fm Listeners)", "@h (20,000 Followers)"),
        ("a (0 Last.fm Listeners)", "@h (0 Followers)"),
        ("a (10,000 Last.fm Listeners)", "N/A"),
    ]


def test_artist_id_is_md5_of_utf8(spark, rows):
    names = ["Björk", "Sigur Rós", "", "日本"]
    df = rows("n STRING", *[(n,) for n in names]).select("n", metrics.artist_id(F.col("n")))
    assert {tuple(r) for r in df.collect()} == {
        (n, hashlib.md5(n.encode()).hexdigest()) for n in names}


def test_plays_per_listener(spark, rows):
    cases = [(10, 3), (5, 0), (2675, 1000), (0, 7), (125, 1000)]
    df = rows("p BIGINT, l BIGINT", *cases)
    got = df.select("p", "l", metrics.plays_per_listener(F.col("p"), F.col("l"))).collect()
    assert {tuple(r) for r in got} == {
        (p, n, round(p / n, 2) if n > 0 else 0.0) for p, n in cases}


def test_exact_round_equals_python(spark, rows):
    rng = random.Random(7)
    cases = [2.675, 0.125, 1.005, 2.5, -2.675, -0.125, 1e9 + 0.005, 0.0, 0.285, 10.25]
    cases += [rng.randrange(10**7) / 1000 for _ in range(3000)]
    cases += [rng.uniform(0, 10**rng.randrange(8)) for _ in range(3000)]
    cases += [rng.randrange(10**6) / 2**rng.randrange(1, 12) for _ in range(2000)]
    df = rows("x DOUBLE", *[(c,) for c in cases])
    for digits in (0, 1, 2, 3):
        got = df.select("x", exact_round(F.col("x"), digits).alias("r")).collect()
        wrong = [(r.x, r.r, round(r.x, digits)) for r in got if r.r != round(r.x, digits)]
        assert not wrong, wrong[:5]


def test_array_round_equals_numpy(spark, rows):
    rng = random.Random(8)
    cases = [2.675, 0.125, 1.005, 0.285] + [rng.randrange(10**6) / 1000 for _ in range(2000)]
    df = rows("x DOUBLE", *[(c,) for c in cases])
    got = df.select("x", array_round(F.col("x"), 2).alias("r")).collect()
    assert all(r.r == np.round(r.x, 2) for r in got)


def test_round_of_null_is_null(spark, rows):
    df = rows("x DOUBLE", (None,))
    assert df.select(exact_round(F.col("x"), 2), array_round(F.col("x"), 2)).first() == (None, None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", "w"]), max_size=8))
def test_genre_tags(spark, tags):
    df = spark.createDataFrame([(tags,)], "t ARRAY<STRING>")
    row = df.select(metrics.genre_tags(F.col("t")).alias("g")).select(
        "g", metrics.primary_genre(F.col("g"))).first()
    assert row[0] == tags[:5]
    assert row[1] == (tags[0] if tags else "unknown")


def test_channel_avg_views(spark, rows):
    df = rows("v BIGINT, n BIGINT", (5, 2), (7, 2), (9, 0), (10, 3))
    got = df.select("v", "n", metrics.channel_avg_views(F.col("v"), F.col("n"))).collect()
    assert {tuple(r) for r in got} == {(5, 2, 2.0), (7, 2, 4.0), (9, 0, 0.0), (10, 3, 3.0)}
