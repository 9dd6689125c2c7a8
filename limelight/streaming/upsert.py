"""Continuous collection: fold arriving batches, newest row per artist.

Each micro-batch is reduced to its newest row per key and written to a folder of its own,
``batch_id=N``. Writing a batch twice replaces that folder, so a restarted stream repeats
its last batch without duplicates, and storing a batch costs what its size costs. Batch
statistics, when asked for, ask the folders' key filters which folders can hold the batch's
keys and read those only. Readers take the newest row per key over all folders; ``compact``
bounds what they combine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.groups import latest_per_key
from ..operators.merge import merge_sources
from ..session import folder_names
from ..sources.tables import optional_source
from .key_filter import known_keys, write_filter


def stored_rows(
    spark: SparkSession, target: str, schema: StructType, snapshot: str | None = None
) -> DataFrame:
    """Rows of all batch folders, with those of a snapshot in front of them."""
    with_batch = StructType([*schema.fields, StructField("batch_id", LongType())])
    rows = optional_source(spark, target, with_batch, "parquet")
    if snapshot is None:
        return rows
    return spark.read.schema(with_batch).parquet(snapshot).unionByName(rows)


def current(
    spark: SparkSession, target: str, schema: StructType, keys: Sequence[str],
    order: Sequence[str], snapshot: str | None = None,
) -> DataFrame:
    """Newest row per key over a snapshot and the batches it does not cover.

    The event order decides, arrival only breaks ties, so late rows never win. A snapshot
    remembers the batch of each row; batch folders it covers are harmless to read again.
    """
    rows = stored_rows(spark, target, schema, snapshot)
    return latest_per_key(rows, keys, [*order, "batch_id"])


def compact(
    spark: SparkSession, target: str, schema: StructType, keys: Sequence[str],
    order: Sequence[str], new_snapshot: str, snapshot: str | None = None,
) -> None:
    """Write the current rows as a new snapshot, with the filter of their keys.

    Batch folders it covers may then go.
    """
    current(spark, target, schema, keys, order, snapshot).write.mode("errorifexists").parquet(
        new_snapshot
    )
    write_filter(spark.read.parquet(new_snapshot), keys, new_snapshot)


def stored_folders(
    spark: SparkSession, target: str, before: int, snapshot: str | None = None
) -> dict[int, str]:
    """Folders with the rows of batches before ``before``; a snapshot counts as batch -1."""
    numbers = [int(n.partition("=")[2]) for n in folder_names(spark, target) if n.startswith("batch_id=")]
    folders = {n: f"{target}/batch_id={n}" for n in numbers if n < before}
    return folders if snapshot is None else {-1: snapshot, **folders}


def batch_stats(
    spark: SparkSession, batch: DataFrame, folders: Mapping[int, str], keys: Sequence[str],
    source: str, visited: list[int] | None = None,
) -> DataFrame:
    """Rows, keys and previously unseen keys of one batch.

    ``folders`` hold the rows stored before. Only those are read that by their key filters
    can hold a key of the batch, so a batch of new artists reads none.
    """
    per_key = batch.groupBy(*keys).agg(F.count("*").alias("n"))
    seen = known_keys(spark, per_key.select(*keys), keys, folders, visited).withColumn(
        "_seen", F.lit(1)
    )
    return per_key.join(seen, list(keys), "left").agg(
        F.lit(source).alias("source"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("arrived"),
        F.count("*").alias("artists"),
        F.count_if(F.col("_seen").isNull()).alias("new_artists"),
    )


def stream_upsert(
    spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
    keys: Sequence[str] = ("artist_id",), order: Sequence[str] = ("collection_timestamp",),
    stats: str | None = None, source: str = "listening", snapshot: str | None = None,
    files_per_batch: int | None = None, format: str = "parquet", interval: str | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start folding landed files into ``target``.

    Without ``interval`` the query takes what has landed and stops; with it, it keeps
    polling. The checkpoint folder remembers processed files across restarts, and
    ``after_batch`` runs once the batch is stored (for example to refresh a merged table).
    ``snapshot`` lets the statistics know the keys of batch folders that were compacted.
    """
    reader = spark.readStream.schema(schema).format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def fold(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if stats is not None:
            earlier = stored_folders(session, target, batch_id, snapshot)
            batch_stats(session, batch, earlier, keys, source).write.mode("overwrite").parquet(
                f"{stats}/batch={batch_id}"
            )
        folder = f"{target}/batch_id={batch_id}"
        latest_per_key(batch, keys, order).write.mode("overwrite").parquet(folder)
        write_filter(session.read.schema(schema).parquet(folder), keys, folder)
        if after_batch is not None:
            after_batch(batch_id)

    writer = reader.load(landing).writeStream.foreachBatch(fold).option(
        "checkpointLocation", checkpoint
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def refresh_merged(
    listening: DataFrame, social: DataFrame, video: DataFrame, path: str, version: int,
    at: dt.datetime | None = None,
) -> str:
    """Write the merged raw table as a new version; earlier versions stay readable."""
    out = f"{path}/version={version}"
    merge_sources(listening, social, video, at).write.mode("overwrite").parquet(out)
    return out
