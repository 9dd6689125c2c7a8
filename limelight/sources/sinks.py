"""Writers for reports, the raw table and the scored table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField

from .. import schemas
from ..config import ScoreConfig, TABLE
from ..operators.merge import merge_sources
from ..plans import reports
from ..plans.scoring import score
from ..session import folder_names, path_exists, remove_path, rename_path


def write_report_csv(report: DataFrame, path: str) -> None:
    """Replace a report; one that can't be computed leaves the last report as it was.

    The new report is written beside the old one, which then makes room for it.
    """
    spark, path = report.sparkSession, path.rstrip("/")
    number = uuid.uuid4().hex
    fresh, old = f"{path}.new-{number}", f"{path}.old-{number}"
    try:
        # quotes inside quoted fields are doubled, as the reader expects
        report.write.options(header=True, quote='"', escape='"').csv(fresh)
    except Exception:
        remove_path(spark, fresh)
        raise
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, fresh, path)
    remove_path(spark, old)


def write_insights(scored: DataFrame, folder: str) -> None:
    """Write the three report extracts: best artists, genres, fastest growing artists.

    The scored rows are kept while the extracts are written, so they are computed once.
    """
    kept_by_caller = scored.is_cached
    scored.persist()
    try:
        write_report_csv(reports.top_underrated(scored, 20), f"{folder}/top_underrated_artists")
        write_report_csv(reports.genre_summary(scored), f"{folder}/genre_analysis")
        write_report_csv(reports.high_growth(scored), f"{folder}/high_growth_artists")
    finally:
        if not kept_by_caller:
            scored.unpersist()


def _declared(field: StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if not field.nullable:
        # checked row by row while writing, not in a pass of its own
        missing = F.raise_error(F.lit(f"{field.name} is required")).cast(field.dataType)
        value = F.coalesce(value, missing)
    return value.alias(field.name)


def declared_raw(raw: DataFrame) -> DataFrame:
    """Project to the declared raw schema; a NULL in a required column fails the job."""
    return raw.select(*[_declared(f) for f in schemas.RAW.fields])


def _old_name(table: str) -> str:
    return f"{table}__replaced"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def recover_table(spark: SparkSession, table: str) -> None:
    """Give a table its name back that a crash left under the name it is replaced by."""
    old = _old_name(table)
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def _replace(
    df: DataFrame, table: str, path: str | None, *partitions: str, buckets: int | None = None,
    bucket_by: str = "artist_id",
) -> None:
    """Write a new version beside the old one, then let the table's name point to it.

    A job that fails leaves the table and its files as they were, and nothing of its own: the
    new version is a table of its own, with its partitions and buckets, before the names
    change hands. First the old table steps aside, then the new one takes the name; a crash
    in between is mended by ``recover_table``, which the next replacement calls. The last
    version's files stay until the one after it is replaced, so its readers can finish.
    """
    spark = df.sparkSession
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    base = (path or f"{warehouse}/{table.rsplit('.', 1)[-1]}").rstrip("/")
    number = uuid.uuid4().hex
    fresh, folder = f"{table}_{number}", f"version-{number}"
    writer = df.write.format("parquet").option("path", f"{base}/{folder}").partitionBy(*partitions)
    if buckets is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        remove_path(spark, f"{base}/{folder}")
        raise
    recover_table(spark, table)
    last = None
    if spark.catalog.tableExists(table):
        last = _location(spark, table).rsplit("/", 1)[-1]
        spark.sql(f"ALTER TABLE {table} RENAME TO {_old_name(table)}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {_old_name(table)}")
    # only what this function wrote; a table kept elsewhere keeps its files
    for name in folder_names(spark, base):
        if name.startswith("version-") and name not in (folder, last):
            remove_path(spark, f"{base}/{name}")


def write_raw_table(raw: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the raw table, partitioned by collection date."""
    _replace(declared_raw(raw), table, path, "collection_date")


def build_scores_table(
    raw: DataFrame, table: str, cfg: ScoreConfig = TABLE, path: str | None = None
) -> None:
    """Replace the scored table with the scoring query's result."""
    _replace(score(raw, cfg), table, path)


def write_source_table(
    source: DataFrame, table: str, buckets: int | None = None, path: str | None = None
) -> None:
    """Replace a per-source table, optionally bucketed and sorted by artist.

    Source tables stored with the same number of buckets merge without a shuffle.
    """
    _replace(source, table, path, buckets=buckets)


def load_sources(
    listening: DataFrame, social: DataFrame, video: DataFrame, names: Sequence[str], raw: str,
    scores: str | None = None, buckets: int | None = None, at: dt.datetime | None = None,
    folder: str | None = None, cfg: ScoreConfig = TABLE,
) -> None:
    """Store the three source tables, merge what was stored, and replace the raw table.

    ``names`` are the tables of listening, social and video. With ``scores`` the scored
    table follows from the stored raw one. A step that fails leaves its own and all later
    tables as they were.
    """
    spark = listening.sparkSession
    place = lambda name: None if folder is None else f"{folder}/{name}"
    for source, name in zip((listening, social, video), names, strict=True):
        write_source_table(source, name, buckets, place(name))
    write_raw_table(merge_sources(*[spark.table(n) for n in names], at), raw, place(raw))
    if scores is not None:
        build_scores_table(spark.table(raw), scores, cfg, place(scores))
