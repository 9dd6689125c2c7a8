"""Tables kept up by batch against tables made anew, and key filters against the keys."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from limelight import schemas
from limelight.operators.groups import latest_per_key
from limelight.operators.merge import merge_sources
from limelight.plans import reports
from limelight.plans.scoring import score
from limelight.streaming import changes, key_filter, upsert

AT = dt.datetime(2024, 5, 1)


def at(minute: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, minute // 60, minute % 60, tzinfo=dt.timezone.utc)


def source_rows(rng, source, ids):
    """Rows of a source with a random time, early or late."""
    out = []
    for i in ids:
        time = at(rng.randrange(12))
        if source == "listening":
            listeners = rng.choice([None, rng.randrange(4000, 250_000)])
            out.append((i, f"n{i}", "u", listeners, 10 * (listeners or 1), rng.choice([None, 9.5]), "g",
                        rng.choice(["jazz", "folk", "pop", None]), time))
        elif source == "social":
            out.append((i, f"h{i}", rng.choice([None, rng.randrange(1000, 120_000)]), 1, 2, 3.0, 4.0,
                        rng.choice([None, 0.5, 2.25]), 5, True, time))
        else:
            out.append((i, f"c{i}", rng.choice([None, rng.randrange(10_000)]), 7, 8, 9.0, time))
    return out


def schema(source):
    raw = {f.name: f for f in schemas.RAW.fields}
    columns = ", ".join(f"{c} {raw[c].dataType.simpleString()}" for c in changes.BROUGHT[source])
    return f"artist_id STRING, {columns}, collection_timestamp TIMESTAMP"


def comparable(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def full_refresh(spark, arrived):
    """All arrivals reduced to the newest row and merged from scratch."""
    newest = {}
    for source in changes.BROUGHT:
        rows = [(*r, n) for n, batches in enumerate(arrived) for r in batches.get(source, [])]
        df = spark.createDataFrame(rows, f"{schema(source)}, arrival INT")
        newest[source] = latest_per_key(df.dropna(subset=["artist_id"]), ["artist_id"],
                                        ["collection_timestamp", "arrival"])
    return merge_sources(*newest.values(), AT).select(*schemas.names(schemas.RAW))


def test_twenty_batches_equal_a_full_refresh(spark, tmp_path):
    rng = random.Random(11)
    store = changes.MergedStore(spark, str(tmp_path / "kept"), buckets=8)
    arrived, counts = [], []
    for number in range(20):
        sources = rng.sample(list(changes.BROUGHT), rng.randint(1, 3))
        # few artists a batch, sometimes none, and ids that only some sources know
        arrived.append({
            s: source_rows(rng, s, rng.sample(range(60), rng.choice([0, 2, 3, 9]))) for s in sources
        })
        batches = {s: spark.createDataFrame([(str(r[0]), *r[1:]) for r in rows], schema(s))
                   for s, rows in arrived[-1].items()}
        arrived[-1] = {s: [(str(r[0]), *r[1:]) for r in rows] for s, rows in arrived[-1].items()}
        touched = store.refresh(number, batches, AT)
        ids = {r[0] for rows in arrived[-1].values() for r in rows}
        assert len(touched) <= len(ids)
        counts += [(s, number, len(rows)) for s, rows in arrived[-1].items() if rows]
        if number % 5 == 4:
            raw = full_refresh(spark, arrived)
            assert comparable(store.merged()) == comparable(raw)
            scored = score(raw)
            assert comparable(store.scored()) == comparable(scored)
            for kept, report in (
                (changes.kept_genre_summary, reports.genre_summary),
                (changes.kept_growth_summary, reports.growth_summary),
            ):
                got, want = (f.toPandas().sort_values(f.columns[0]).reset_index(drop=True)
                             for f in (kept(store.summary()), report(scored)))
                assert got.columns.tolist() == want.columns.tolist()
                assert got.iloc[:, 0].astype(str).tolist() == want.iloc[:, 0].astype(str).tolist()
                for c in got.columns[1:]:
                    assert got[c].tolist() == pytest.approx(want[c].tolist(), rel=1e-9, nan_ok=True)
    assert sorted(tuple(r)[:3] for r in changes.kept_source_counts(store.summary()).collect()) == sorted(counts)


@pytest.fixture
def small_store(spark, tmp_path):
    def rows(*ids, time=0, name="n"):
        return spark.createDataFrame(
            [(i, f"{name}{i}", "u", 9000, 1, 1.0, "g", "jazz", at(time)) for i in ids], schema("listening"))

    return changes.MergedStore(spark, str(tmp_path / "kept"), buckets=64), rows


def test_untouched_buckets_are_carried_and_never_read(spark, small_store):
    store, rows = small_store
    store.refresh(0, {"listening": rows(*map(str, range(200)))}, AT)
    before = set(store.merged().inputFiles())
    (touched,) = store.refresh(1, {"listening": rows("7", time=5, name="new")}, AT)
    after = set(store.merged().inputFiles())
    gone = {f for f in before - after}
    assert gone and all(f"/bucket={touched}/" in f for f in gone)
    assert all("/version=1/" in f for f in after - before)
    (name,) = values(store.merged().where("artist_id = '7'"), "artist_name")
    assert name == "new7" and store.merged().count() == 200
    # had the refresh read another bucket's files, it would now fail
    for path in before & after:
        os.remove(path.removeprefix("file://").removeprefix("file:"))
    store.refresh(2, {"listening": rows("7", time=9, name="newer")}, AT)


def test_a_batch_that_runs_again_replaces_itself(spark, small_store):
    store, rows = small_store
    store.refresh(0, {"listening": rows("a", "b")}, AT)
    store.refresh(1, {"listening": rows("b", "c", time=3)}, AT)
    first = comparable(store.merged()), comparable(store.summary())
    store.refresh(1, {"listening": rows("b", "c", time=3)}, AT)
    assert (comparable(store.merged()), comparable(store.summary())) == first


def test_a_refresh_that_fails_leaves_the_last_version(spark, small_store):
    store, rows = small_store
    store.refresh(0, {"listening": rows("a")}, AT)
    broken = rows("a", time=2).withColumn("genres", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.refresh(1, {"listening": broken}, AT)
    assert store.versions() == [0] and values(store.merged(), "artist_name") == ["na"]


def test_late_and_early_rows_of_other_sources(spark, small_store):
    store, rows = small_store
    social = spark.createDataFrame([("a", "h", 20_000, 1, 1, 1.0, 1.0, 2.0, 1, True, at(1))], schema("social"))
    store.refresh(0, {"social": social}, AT)
    assert store.merged().count() == 0  # not listed before its listening row is there
    store.refresh(1, {"listening": rows("a", time=5)}, AT)
    store.refresh(2, {"listening": rows("a", time=4, name="late")}, AT)
    (row,) = store.merged().collect()
    assert (row["artist_name"], row["instagram_followers"]) == ("na", 20_000)
    store.refresh(3, {}, AT)
    assert store.merged().count() == 1 and store.versions() == [0, 1, 2, 3]


def test_vacuum_keeps_what_is_referred_to(spark, small_store):
    store, rows = small_store
    for number in range(4):
        store.refresh(number, {"listening": rows("a", str(number), time=number)}, AT)
    store.vacuum(keep=1)
    assert store.versions() == [3]
    assert values(store.merged(), "artist_id") == ["0", "1", "2", "3", "a"]
    assert store.scored().count() == 5


# --- key filters -------------------------------------------------------------------------


def folder(spark, base, number, keys):
    path = f"{base}/batch_id={number}"
    df = spark.createDataFrame([(k, number) for k in keys], "artist_id STRING, v INT")
    df.write.parquet(path)
    key_filter.write_filter(spark.read.parquet(path), ["artist_id"], path)
    return path


def test_filters_rule_folders_out_and_are_hidden(spark, tmp_path):
    base = str(tmp_path)
    keys = {n: [f"k{n}-{i}" for i in range(3000)] for n in range(3)}
    folders = {n: folder(spark, base, n, keys[n]) for n in keys}
    assert spark.read.parquet(base).count() == 9000  # readers do not see the filters
    wanted = spark.createDataFrame([(k,) for n in keys for k in keys[n]], "artist_id STRING")
    maybe = {(r[0], r[1]) for r in key_filter.may_hold(spark, wanted, ["artist_id"], folders).collect()}
    assert {(k, n) for n in keys for k in keys[n]} <= maybe  # no key is ruled out wrongly
    assert len(maybe) - 9000 < 0.02 * 18000  # false positives
    visited = []
    fresh = spark.createDataFrame([("k1-5",), ("new",), (None,)], "artist_id STRING")
    known = key_filter.known_keys(spark, fresh, ["artist_id"], folders, visited)
    assert values(known) == ["k1-5"] and visited == [1]


def test_false_positives_do_not_count_as_known(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_filter, "KEYS_PER_BLOCK", 5000)  # filters that rule out little
    folders = {n: folder(spark, str(tmp_path), n, [f"k{n}-{i}" for i in range(2000)]) for n in range(2)}
    wanted = spark.createDataFrame([(f"x{i}",) for i in range(300)] + [("k0-1",)], "artist_id STRING")
    assert key_filter.may_hold(spark, wanted, ["artist_id"], folders).count() > 100
    visited = []
    assert values(key_filter.known_keys(spark, wanted, ["artist_id"], folders, visited)) == ["k0-1"]
    assert set(visited) == {0, 1}


def test_folders_without_a_filter_and_empty_ones(spark, tmp_path):
    old = str(tmp_path / "batch_id=0")
    spark.createDataFrame([("a", 1)], "artist_id STRING, v INT").write.parquet(old)
    empty = folder(spark, str(tmp_path), 1, [])
    wanted = spark.createDataFrame([("a",), ("b",)], "artist_id STRING")
    known = key_filter.known_keys(spark, wanted, ["artist_id"], {0: old, 1: empty})
    assert values(known) == ["a"]
    assert key_filter.known_keys(spark, wanted, ["artist_id"], {}).count() == 0


def test_statistics_read_only_the_folders_of_known_keys(spark, tmp_path):
    landing, target, checkpoint, stats = (str(tmp_path / n) for n in ("l", "t", "c", "s"))
    ddl = "artist_id STRING, collection_timestamp TIMESTAMP"
    for number, ids in enumerate((["a", "b"], ["c", "d"], ["e", "a"])):
        df = spark.createDataFrame([(i, at(number)) for i in ids], ddl)
        df.coalesce(1).write.mode("append").parquet(landing)
        upsert.stream_upsert(spark, landing, df.schema, target, checkpoint, stats=stats).awaitTermination()
    assert values(spark.read.parquet(stats), "batch", "artists", "new_artists") == [
        (0, 2, 2), (1, 2, 2), (2, 2, 1)]
    folders = upsert.stored_folders(spark, target, 3)
    assert sorted(folders) == [0, 1, 2]
    visited = []
    batch = spark.createDataFrame([("d", at(9)), ("new", at(9))], ddl)
    (row,) = upsert.batch_stats(spark, batch, folders, ["artist_id"], "x", visited).collect()
    assert (row["artists"], row["new_artists"], visited) == (2, 1, [1])
    # the others may be gone: they are not read
    for number in (0, 2):
        for name in os.listdir(folders[number]):
            if name.startswith("part-"):
                os.remove(f"{folders[number]}/{name}")
    assert upsert.batch_stats(spark, batch, folders, ["artist_id"], "x").first()["new_artists"] == 1
