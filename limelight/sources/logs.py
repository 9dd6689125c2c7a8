"""Collection logs: lines of the form ``[time] [LEVEL] message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The line format and the texts looked for.
LINE = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\] \[(\w+)\] (.*)$"
RATE_LIMIT = r"(?i)rate limit|22 minutes|401"
PROGRESS = r"Step|Running|Successfully|ERROR"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their place: file, block within the file, line within the block."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_ord"),
    )


def log_events(lines: DataFrame) -> DataFrame:
    """Time, level and message of every line, with its two flags.

    ``lines`` holds (value, line_ord). Messages may span lines: a continuation line has
    no time and level of its own, and is flagged like any other line.
    """
    head = F.col("value").rlike(LINE)

    def part(n: int) -> Column:
        return F.when(head, F.regexp_extract("value", LINE, n))

    return lines.select(
        "line_ord",
        F.try_to_timestamp(part(1)).alias("logged_at"),
        part(2).alias("level"),
        F.coalesce(part(3), F.col("value")).alias("message"),
        F.col("value").rlike(RATE_LIMIT).alias("rate_limited"),
        F.col("value").rlike(PROGRESS).alias("progress"),
    )


def recent_log_events(events: DataFrame, n: int = 50) -> DataFrame:
    """The last n lines."""
    return events.orderBy(F.desc("line_ord")).limit(n)


def rate_limit_seen(events: DataFrame, n: int = 50) -> DataFrame:
    """Whether one of the last n lines reports a rate limit."""
    return recent_log_events(events, n).agg(
        F.count("*").alias("lines"),
        F.coalesce(F.bool_or("rate_limited"), F.lit(False)).alias("rate_limited"),
    )


def recent_progress(events: DataFrame, window: int = 10, n: int = 5) -> DataFrame:
    """The last step and error lines among the newest lines."""
    return recent_log_events(recent_log_events(events, window).where("progress"), n)
