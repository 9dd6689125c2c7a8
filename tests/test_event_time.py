"""Streams with a watermark against the rows that came in time; the clustered scored table."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from limelight import schemas
from limelight.plans import reports
from limelight.sources import clustered
from limelight.streaming import event_time, upsert

DDL = "event_id BIGINT, artist_id STRING, source STRING, collection_timestamp TIMESTAMP, v STRING"
ORDER = ["collection_timestamp", "event_id"]


def at(hours: float) -> dt.datetime:
    return dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "target", "checkpoint")]


def land(spark, landing, rows):
    df = spark.createDataFrame(rows, DDL).coalesce(1)
    df.write.mode("append").parquet(landing)
    return df.schema


def test_late_and_repeated_rows_count_once_and_restarts_go_on(spark, places):
    landing, target, checkpoint = places
    batches = [
        [(1, "a", "s", at(1), ""), (2, "b", "s", at(20), ""), (3, "a", "t", at(30), "")],
        # late by less than two days, and a copy of a row that came before
        [(4, "c", "s", at(2), ""), (2, "b", "s", at(20), ""), (5, "a", "s", at(49), "")],
        # closes the first two days: the next batch may add nothing to them
        [(6, "a", "t", at(24 * 4 + 1), "")],
        [(7, "d", "s", at(3), ""), (8, "d", "t", at(24 * 3 + 5), "")],
        [(9, "a", "s", at(24 * 8), "")],
    ]
    after = []
    for rows in batches:
        schema = land(spark, landing, rows)
        event_time.stream_source_counts(
            spark, landing, schema, target, checkpoint, ["event_id"], late="2 days").awaitTermination()
        counted = spark.read.parquet(target) if os.path.isdir(target) else None
        after.append(values(counted, "source", F.dayofmonth("start"), "n") if counted is not None else [])
    assert after[0] == after[1] == []
    assert after[2] == [("s", 1, 3), ("t", 2, 1)]
    assert after[3] == after[2]
    # row 7 came when its day was given out; row 8 in time
    assert after[4] == [("s", 1, 3), ("s", 3, 1), ("t", 2, 1), ("t", 4, 1), ("t", 5, 1)]
    event_time.stream_source_counts(
        spark, landing, schema, target, checkpoint, ["event_id"], late="2 days").awaitTermination()
    assert values(spark.read.parquet(target), "source", F.dayofmonth("start"), "n") == after[4]


@pytest.mark.parametrize("seed", [1, 2])
def test_newest_rows_as_state_equal_current(spark, places, seed, tmp_path):
    landing, target, checkpoint = places
    rng = random.Random(seed)
    rows = [(i, f"a{rng.randrange(12)}", "s", at(rng.randrange(2000)), f"v{i}") for i in range(150)]
    rng.shuffle(rows)  # rows land in any order
    for part in range(4):
        schema = land(spark, landing, rows[part::4])
        event_time.stream_newest(
            spark, landing, schema, target, checkpoint, order=ORDER, late="365 days").awaitTermination()
    newest = {}
    for r in rows:
        newest[r[1]] = max(newest.get(r[1], r), r, key=lambda x: (x[3], x[0]))
    got = upsert.current(spark, target, schema, ["artist_id"], ORDER)
    assert values(got, "artist_id", "event_id", "v") == sorted((k, r[0], r[4]) for k, r in newest.items())
    plain = str(tmp_path / "plain")
    upsert.stream_upsert(spark, landing, schema, plain, str(tmp_path / "cp"), order=ORDER).awaitTermination()
    assert values(got.drop("batch_id")) == values(
        upsert.current(spark, plain, schema, ["artist_id"], ORDER).drop("batch_id"))


def test_state_of_past_windows_is_dropped(spark, places):
    landing, target, checkpoint = places
    late = [[(1, "a", "s", at(0), "first")], [(2, "b", "s", at(24 * 200), "later")],
            [(3, "a", "s", at(1), "too late")], [(4, "c", "s", at(24 * 201), "x")]]
    for rows in late:
        schema = land(spark, landing, rows)
        query = event_time.stream_newest(spark, landing, schema, target, checkpoint, order=ORDER)
        query.awaitTermination()
    progress = [p for p in query.recentProgress if p["stateOperators"]]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2  # of b and c; a's is gone
    assert values(upsert.current(spark, target, schema, ["artist_id"], ORDER), "artist_id", "v") == [
        ("a", "first"), ("b", "later"), ("c", "x")]


# --- the clustered scored table --------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    fields = schemas.SCORED.fieldNames()
    rows = []
    for i in range(500):
        row = dict.fromkeys(fields)
        row |= {"artist_id": f"a{i:03}", "artist_name": f"n{i}",
                "priority_score": rng.choice([None, 1.0, float(rng.randrange(50)), rng.random() * 9])}
        rows.append(tuple(row[f] for f in fields))
    return spark.createDataFrame(rows, schemas.SCORED)


@pytest.mark.parametrize("n", [0, 1, 7, 50, 120, 600])
def test_top_rows_come_from_the_leading_files(spark, scored, tmp_path, n):
    path = str(tmp_path / "clustered")
    clustered.write_clustered(scored, path, file_rows=25)
    want = [r["artist_id"] for r in scored.orderBy(*reports.score_order()).limit(n).collect()]
    top = clustered.read_top(spark, path, n)
    assert [r["artist_id"] for r in top.collect()] == want
    files = len([f for f in os.listdir(path) if f.startswith("part-")])
    assert files >= 15
    if 0 < n <= 120:
        assert len(top.inputFiles()) < files / 2


def test_ranks_equal_a_sort(spark, scored, tmp_path):
    path = str(tmp_path / "clustered")
    clustered.write_clustered(scored, path, file_rows=40)
    want = [(r["artist_id"], i) for i, r in enumerate(scored.orderBy(*reports.score_order()).collect(), 1)]
    assert values(clustered.read_ranked(spark, path), "artist_id", "rank") == sorted(want)
    first = clustered.read_ranked(spark, path, upto=60)
    assert values(first, "artist_id", "rank") == sorted(want[:60])
    assert spark.read.parquet(path).count() == 500  # the facts are hidden


def test_an_empty_table_has_no_top(spark, scored, tmp_path):
    path = str(tmp_path / "empty")
    clustered.write_clustered(scored.limit(0), path)
    assert clustered.read_top(spark, path, 5).isEmpty() and clustered.read_ranked(spark, path).isEmpty()
