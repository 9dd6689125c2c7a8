"""Incremental upsert: arrival order, restarts, statistics and compaction."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import values
from limelight import schemas
from limelight.operators.groups import latest_per_key
from limelight.streaming import upsert

SCHEMA = "artist_id STRING, collection_timestamp TIMESTAMP, seq INT, v STRING"
KEYS, ORDER = ["artist_id"], ["collection_timestamp", "seq"]


def at(minute: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, 0, minute, tzinfo=dt.timezone.utc)


BATCHES = [
    [("a", at(1), 0, "a1"), ("a", at(1), 1, "a1b"), ("b", at(1), 0, "b1")],
    [("a", at(3), 0, "a3"), ("c", at(2), 0, "c2")],
    [("a", at(2), 0, "late"), ("b", at(4), 0, "b4"), ("d", at(4), 0, "d4")],
]
EXPECTED = [("a", "a3"), ("b", "b4"), ("c", "c2"), ("d", "d4")]


class Places:
    def __init__(self, spark, base):
        self.spark = spark
        self.landing, self.target, self.checkpoint, self.stats = (
            str(base / n) for n in ("landing", "target", "checkpoint", "stats"))

    def land(self, batch):
        df = self.spark.createDataFrame(batch, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(self.landing)
        return df.schema

    def fold(self, schema, **kwargs):
        query = upsert.stream_upsert(
            self.spark, self.landing, schema, self.target, self.checkpoint,
            KEYS, ORDER, stats=self.stats, **kwargs)
        query.awaitTermination()
        return query

    def current(self, schema, **kwargs):
        return upsert.current(self.spark, self.target, schema, KEYS, ORDER, **kwargs)


@pytest.fixture
def places(spark, tmp_path):
    return Places(spark, tmp_path)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_arrival_order_does_not_matter(spark, places, order):
    for i in order:
        schema = places.land(BATCHES[i])
        places.fold(schema)
    assert values(places.current(schema), "artist_id", "v") == EXPECTED
    everything = spark.createDataFrame(sum(BATCHES, []), SCHEMA)
    assert values(latest_per_key(everything, KEYS, ORDER), "artist_id", "v") == EXPECTED


def test_resume_reads_only_new_files_and_counts_them(spark, places):
    for batch in BATCHES:
        schema = places.land(batch)
        places.fold(schema)
    places.fold(schema)  # nothing new: no batch
    stats = spark.read.parquet(places.stats)
    assert values(stats, "batch", "source", "arrived", "artists", "new_artists") == [
        (0, "listening", 3, 2, 2), (1, "listening", 2, 2, 1), (2, "listening", 3, 3, 1)]


def test_several_files_per_start_make_several_batches(spark, places):
    for batch in BATCHES:
        schema = places.land(batch)
    seen = []
    places.fold(schema, files_per_batch=1, after_batch=seen.append)
    assert seen == [0, 1, 2]
    assert values(places.current(schema), "artist_id", "v") == EXPECTED


def test_failure_after_the_write_leaves_no_duplicates(spark, places):
    schema = places.land(BATCHES[0])

    def fail(batch_id):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        places.fold(schema, after_batch=fail)
    schema = places.land(BATCHES[1])
    places.fold(schema)
    places.fold(schema)
    stored = spark.read.parquet(places.target)
    assert stored.where("batch_id = 0").count() == 2
    assert values(places.current(schema), "artist_id", "v") == [
        ("a", "a3"), ("b", "b1"), ("c", "c2")]
    assert spark.read.parquet(places.stats).agg({"arrived": "sum"}).first()[0] == 5


def test_snapshot_plus_later_batches(spark, places, tmp_path):
    first, second = str(tmp_path / "s1"), str(tmp_path / "s2")
    schema = places.land(BATCHES[0])
    places.fold(schema)
    upsert.compact(spark, places.target, schema, KEYS, ORDER, first)
    for batch in BATCHES[1:]:
        places.land(batch)
        places.fold(schema)
    assert values(places.current(schema, snapshot=first), "artist_id", "v") == EXPECTED
    upsert.compact(spark, places.target, schema, KEYS, ORDER, second, first)
    assert values(spark.read.parquet(second), "artist_id", "v") == EXPECTED


def test_compacted_folders_still_count_as_known(spark, places, tmp_path):
    snapshot = str(tmp_path / "snapshot")
    schema = places.land(BATCHES[0])
    places.fold(schema)
    upsert.compact(spark, places.target, schema, KEYS, ORDER, snapshot)
    places.target = str(tmp_path / "emptied")  # the covered folder is gone
    places.land(BATCHES[1])
    places.fold(schema, snapshot=snapshot)
    stats = spark.read.parquet(places.stats).where("batch = 1")
    assert values(stats, "arrived", "artists", "new_artists") == [(2, 2, 1)]
    assert values(places.current(schema, snapshot=snapshot), "artist_id", "v") == [
        ("a", "a3"), ("b", "b1"), ("c", "c2")]


def test_refresh_merged_after_each_batch(spark, tmp_path):
    def listening(day, *ids):
        stamp = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
        return spark.createDataFrame(
            [(i, f"{i}{day}", 9000, 1, 1.0, "", "jazz", "jazz", "uk_top", stamp.date(), stamp)
             for i in ids], schemas.LISTENING)

    landing, target, out = (str(tmp_path / n) for n in ("landing", "target", "merged"))
    read = lambda: upsert.current(
        spark, target, schemas.LISTENING, KEYS, ["collection_timestamp"]).drop("batch_id")

    def refresh(batch_id):
        upsert.refresh_merged(
            read(), spark.createDataFrame([], schemas.SOCIAL),
            spark.createDataFrame([], schemas.VIDEO), out, batch_id)

    for day, ids in ((1, "ab"), (2, "bc")):
        listening(day, *ids).write.mode("append").parquet(landing)
        upsert.stream_upsert(spark, landing, schemas.LISTENING, target, str(tmp_path / "cp"),
                             after_batch=refresh).awaitTermination()
    assert values(spark.read.parquet(f"{out}/version=0"), "artist_name") == ["a1", "b1"]
    assert values(spark.read.parquet(f"{out}/version=1"), "artist_name") == ["a1", "b2", "c2"]
