"""CSV records with line breaks inside fields, read from any number of splits of a file.

A line break ends a record unless an odd number of quotes stands before it in the file, since
quotes inside fields are doubled. So a file is read as lines, in as many splits as Spark cuts
it into. Each split's quotes are counted, a running parity over the splits tells whether a
split begins inside a field, and the same over its lines whether a line does. Lines that hold
a whole record, almost all, are records at once; the others are put together by the number of
records that begin before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import stored_once


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, quotes, value): lines in the order of place within their split."""
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        (F.length("value") - F.length(F.replace(value, F.lit('"'), F.lit("")))).cast("bigint").alias("quotes"),
        "value",
    )


def _before(value: str | Column, window) -> Column:
    """Sum over the rows before a row."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def _numbered(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with whether a record begins there, and how many of their split's begin so far."""
    here = Window.partitionBy("file", "block").orderBy("place")
    starts = (F.col("inside") + _before("quotes", here)) % 2 == 0
    return lines.join(splits, ["file", "block"]).withColumn("starts", starts).withColumn(
        "begun", F.sum(F.col("starts").cast("bigint")).over(here)
    )


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record): the records of all files, numbered from 1 in each.

    A file with an odd number of quotes has no end to its last field and fails the job. Empty
    lines between records give none but are numbered. Windows hold the lines of one split,
    however large the file; one row per split of a file goes through one task.
    """
    lines = _lines(spark, path)
    over_splits = Window.partitionBy("file").orderBy("block")
    quotes = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    odd = (F.sum("quotes").over(Window.partitionBy("file")) % 2) == 1
    message = F.concat(F.lit("a quoted field does not end in "), "file")
    inside = stored_once(quotes.select(
        "file", "block", F.when(odd, F.raise_error(message).cast("bigint")).otherwise(
            _before("quotes", over_splits) % 2
        ).alias("inside"),
    ), "split-quotes")
    begun = _numbered(lines.drop("value"), inside).groupBy("file", "block", "inside").agg(
        F.sum(F.col("starts").cast("bigint")).alias("records")
    )
    splits = stored_once(begun.select(
        "file", "block", "inside", _before("records", over_splits).alias("earlier")
    ), "split-records")
    numbered = _numbered(lines, splits).withColumn("number", F.col("earlier") + F.col("begun"))
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = numbered.where(~whole).groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record")
    )
    records = numbered.where(whole).select("file", "number", F.col("value").alias("record"))
    ended = F.regexp_replace("record", "\r$", "")  # line ends of two characters
    return records.unionByName(joined).withColumn("record", ended).where("record <> ''")


def read_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV columns as text, by place; the first record of each file is its header."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    body = split_records(spark, path).where("number > 1")
    # a generator, so that a record is parsed once and not once per column
    parsed = F.explode(F.array(F.from_csv("record", schema, options)))
    return body.select(parsed.alias("r")).select("r.*")
