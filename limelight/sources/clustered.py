"""The scored table in order of its scores, so that the best rows lie in the first files.

The rows are cut into ranges of the score order, one file each, sorted. A small table beside
them, hidden from readers, has each file's rows and its first place in the order. Top rows
come from the leading files alone, and a rank is a file's offset plus the place within it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.groups import score_order


def write_clustered(scored: DataFrame, path: str, file_rows: int = 1_000_000) -> None:
    """Write scored rows in score order, about ``file_rows`` to a file, and the files' facts."""
    spark = scored.sparkSession
    files = max(1, -(-scored.count() // file_rows))
    scored.repartitionByRange(files, *score_order()).sortWithinPartitions(*score_order()).write.mode(
        "overwrite"
    ).parquet(path)
    first = F.min(F.struct(
        F.col("priority_score").isNull(), -F.coalesce("priority_score", F.lit(0.0)), "artist_id"
    ))
    spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), first.alias("first"), F.min("priority_score").alias("lowest"),
        F.max("priority_score").alias("highest"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/_files")


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, rows before it) in score order: one row per file."""
    out, before = [], 0
    for r in spark.read.parquet(f"{path}/_files").orderBy("first").collect():
        out.append((r["file"], before))
        before += r["rows"]
    return out


def read_top(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The best ``n`` rows, best first, from the files that hold them."""
    leading = [f"{path}/{file}" for file, before in _files(spark, path) if before < n]
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*leading) if leading else spark.read.schema(schema).parquet(path)
    return rows.orderBy(*score_order()).limit(n)


def read_ranked(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Rows with their rank from 1; with ``upto`` only the first so many, from their files.

    Every file is ranked on its own; the offsets, one per file, come with the query.
    """
    files = [(f, before) for f, before in _files(spark, path) if upto is None or before < upto]
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.read.schema(schema).parquet(path).withColumn("rank", F.lit(None).cast("bigint"))
    offsets = spark.createDataFrame(files, "_file string, _before bigint")
    rows = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f, _ in files]).withColumn(
        "_file", F.col("_metadata.file_name")
    )
    place = F.row_number().over(Window.partitionBy("_file").orderBy(*score_order()))
    ranked = rows.withColumn("_place", place).join(F.broadcast(offsets), "_file").withColumn(
        "rank", F.col("_before") + F.col("_place")
    ).drop("_file", "_place", "_before")
    return ranked if upto is None else ranked.where(F.col("rank") <= upto)
