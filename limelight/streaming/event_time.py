"""Streams by event time: counts per source and the newest row per artist, as state.

A watermark says how late rows may come. Counts are given out once, when their window can
get no more rows; what comes later than that is left out. Both queries take what has landed
and stop, and go on from their checkpoint when they are started again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.groups import latest_per_key, row_hash


def _landed(
    spark: SparkSession, landing: str, schema: StructType, files_per_batch: int | None, format: str
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing)


def counts_by_time(
    rows: DataFrame, identity: Sequence[str], time: str = "collection_timestamp",
    source: str = "source", window: str = "1 day", late: str = "2 days",
) -> DataFrame:
    """Rows per source and window of event time, each row once however often it lands.

    ``identity`` names the columns that make a row itself. A row counts if it lands before the
    newest time seen is ``late`` after its own; its copies are known for that long.
    """
    return (
        rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(identity))
        .groupBy(F.window(time, window).alias("w"), F.col(source).alias("source"))
        .agg(F.count("*").alias("n"))
        .select("source", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )


def stream_source_counts(
    spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
    identity: Sequence[str], files_per_batch: int | None = None, format: str = "parquet", **options: str,
) -> StreamingQuery:
    """Append the counts of windows that are over to ``target`` (see ``counts_by_time``).

    The file sink's log makes a batch that runs again replace itself.
    """
    rows = _landed(spark, landing, schema, files_per_batch, format)
    return counts_by_time(rows, identity, **options).writeStream.format("parquet").outputMode(
        "append"
    ).option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()


def stream_newest(
    spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
    keys: Sequence[str] = ("artist_id",), order: Sequence[str] = ("collection_timestamp",),
    time: str = "collection_timestamp", window: str = "30 days", late: str = "60 days",
    files_per_batch: int | None = None, format: str = "parquet",
) -> StreamingQuery:
    """Keep the newest row per key as state, and write it whenever it may have changed.

    State is held per key and ``window`` of event time and dropped once the window is ``late``
    behind the newest time seen, so it is bounded by the keys that are active; rows that come
    later than that are left out. Each batch writes the newest rows of its keys to a folder
    ``batch_id=N``, which ``upsert.current`` reads; rows that lose to stored ones are never
    written, and no stored folder is read. ``order`` names ascending columns; rows that tie
    are told apart by a hash, as in batch mode.
    """
    rows = _landed(spark, landing, schema, files_per_batch, format)
    names = rows.columns
    place = F.struct(*[F.col(c) for c in order], row_hash(rows).alias("_hash"))
    kept = rows.withWatermark(time, late).groupBy(
        F.window(time, window).alias("_window"), *[F.col(k).alias(f"_key_{k}") for k in keys]
    ).agg(F.max_by(F.struct(*names), place).alias("_newest")).select("_newest.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, keys, order).write.mode("overwrite").parquet(
            f"{target}/batch_id={batch_id}"
        )

    return kept.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()
