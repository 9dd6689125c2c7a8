"""The merged and the scored table, and what reports sum up of them, kept up by batch.

A batch touches the artists it holds rows of, and no others. The merged rows are kept in
buckets by a hash of the artist; a refresh reads the buckets of the batch's artists, merges
and scores again what changed in them, and writes those buckets as a new version. A manifest
per version names the version of each bucket, so all others are carried along as they are.
Sums over genres and growth classes move by what the changed rows were and what they became.

A refresh reads the state before its own batch, so one that runs again replaces itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import ScoreConfig, TABLE
from ..functions import metrics
from ..functions.numeric import array_round
from ..operators.groups import latest_per_key
from ..operators.merge import SOCIAL_COLUMNS, VIDEO_COLUMNS, stamp_collection
from ..plans.scoring import score
from ..session import folder_names, path_exists, remove_path, stored_once
from ..sources.tables import empty_source

STAMPS = ("collection_date", "last_updated")
LISTENING_COLUMNS = [
    f.name for f in schemas.RAW.fields
    if f.name in schemas.names(schemas.LISTENING) and f.name not in ("artist_id", *STAMPS)
]
#: Columns that each source brings to the merged row.
BROUGHT = {"listening": LISTENING_COLUMNS, "social": SOCIAL_COLUMNS, "video": VIDEO_COLUMNS}
#: Means that the reports show, and how far values may reach: sums are exact decimals, so that
#: what is added and taken away again leaves nothing behind.
MEASURES = (
    "priority_score", "underrated_ratio", "engagement_score", "instagram_followers",
    "lastfm_listeners",
)
EXACT = "decimal(38,15)"


def _state_schema(order: T.StructType) -> T.StructType:
    raw = {f.name: f for f in schemas.RAW.fields}
    fields = [T.StructField("artist_id", T.StringType())]
    for source, columns in BROUGHT.items():
        fields += [T.StructField(c, raw[c].dataType) for c in columns]
        fields += [T.StructField(f"_{source}", order)]  # null: the artist has no such row
    return T.StructType(fields)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("artist_id"), F.lit(buckets)).cast("int")


class MergedStore:
    """Merged and scored rows of all artists below ``path``, one version per batch.

    ``order`` names the columns that tell which of an artist's rows of a source is newest;
    every source's rows have them. Rows that tie go to the later batch. ``buckets`` is fixed
    when the store is first written: a refresh rewrites as many as its batch has artists, at
    most, so stores that take small batches want many.
    """

    def __init__(
        self, spark: SparkSession, path: str, order: T.StructType | None = None,
        buckets: int = 256, cfg: ScoreConfig = TABLE,
    ) -> None:
        self.spark, self.path, self.buckets, self.cfg = spark, path.rstrip("/"), buckets, cfg
        self.order = order or T.StructType([T.StructField("collection_timestamp", T.TimestampType())])
        self.schema = _state_schema(self.order)

    # --- versions -----------------------------------------------------------------------

    def versions(self, before: int | None = None) -> list[int]:
        """Complete versions, oldest first."""
        numbers = sorted(
            int(n.partition("=")[2]) for n in folder_names(self.spark, f"{self.path}/manifest")
        )
        return [
            n for n in numbers if (before is None or n < before)
            and path_exists(self.spark, f"{self.path}/manifest/version={n}/_SUCCESS")
        ]

    def _manifest(self, version: int | None) -> tuple[dict[int, int], str | None]:
        """(version of each bucket, time of the refresh): at most a row per bucket."""
        if version is None:
            return {}, None
        rows = self.spark.read.parquet(f"{self.path}/manifest/version={version}").collect()
        places = {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}
        return places, next((r["at"] for r in rows), None)

    def _last(self, before: int | None = None) -> int | None:
        return next(reversed(self.versions(before)), None)

    def _rows(self, kind: str, schema: T.StructType, places: Mapping[int, int]) -> DataFrame:
        if not places:
            return empty_source(self.spark, schema)
        base = f"{self.path}/{kind}"
        # a bucket may have no scored rows, and so no folder
        written = {v: set(folder_names(self.spark, f"{base}/version={v}")) for v in set(places.values())}
        found = [
            f"{base}/version={v}/bucket={b}" for b, v in sorted(places.items())
            if f"bucket={b}" in written[v]
        ]
        if not found:
            return empty_source(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*found)

    # --- reading ------------------------------------------------------------------------

    def merged(self, version: int | None = None) -> DataFrame:
        """The raw table, every row stamped with the time of the last refresh."""
        places, at = self._manifest(self._last() if version is None else version)
        return self._stamped(self._listed(self._rows("state", self.schema, places)), at, schemas.RAW)

    def scored(self, version: int | None = None) -> DataFrame:
        """The scored table."""
        places, at = self._manifest(self._last() if version is None else version)
        kept = T.StructType([f for f in schemas.SCORED.fields if f.name not in STAMPS])
        return self._stamped(self._rows("scored", kept, places), at, schemas.SCORED)

    def summary(self, version: int | None = None) -> DataFrame:
        """(kind, key, counts and sums) of genres, growth classes and sources."""
        version = self._last() if version is None else version
        return self.spark.read.parquet(f"{self.path}/summary/version={version}")

    def _stamped(self, rows: DataFrame, at: str | None, schema: T.StructType) -> DataFrame:
        time = dt.datetime.fromisoformat(at) if at else None
        return stamp_collection(rows, time).select(*schemas.names(schema))

    def _listed(self, state: DataFrame) -> DataFrame:
        """Merged rows of the artists that have a listening row."""
        return state.where(F.col("_listening").isNotNull()).withColumn(
            "data_quality_score", metrics.data_quality_score()
        ).drop(*[f"_{s}" for s in BROUGHT])

    def _scored(self, state: DataFrame) -> DataFrame:
        """Scores do not depend on the stamps, so rows carried along keep theirs."""
        stampless = self._listed(state).withColumns({
            c: F.lit(None).cast(T.DateType() if c == "collection_date" else T.TimestampType())
            for c in STAMPS
        })
        return score(stampless, self.cfg).drop(*STAMPS)

    # --- refreshing ---------------------------------------------------------------------

    def _newest(self, source: str, batch: DataFrame) -> DataFrame:
        order = self.order.fieldNames()
        return latest_per_key(batch.dropna(subset=["artist_id"]), ["artist_id"], order).select(
            "artist_id", F.struct(*[F.col(c).cast(self.order[c].dataType).alias(c) for c in order])
            .alias(f"_{source}"), *BROUGHT[source],
        )

    def _folded(self, old: DataFrame, source: str, batch: DataFrame) -> DataFrame:
        """``old`` with a source's newer rows in it."""
        own = (f"_{source}", *BROUGHT[source])
        fresh = self._newest(source, batch)
        fresh = fresh.select("artist_id", *[F.col(c).alias(f"new{c}") for c in own])
        joined = old.join(fresh, "artist_id", "full_outer")
        mark, new = F.col(f"_{source}"), F.col(f"new_{source}")
        wins = new.isNotNull() & (mark.isNull() | (new >= mark))
        return joined.withColumns({
            c: F.when(wins, F.col(f"new{c}")).otherwise(F.col(c)) for c in own
        }).select(*self.schema.names)

    def refresh(
        self, batch_id: int, batches: Mapping[str, DataFrame], at: dt.datetime | None = None
    ) -> list[int]:
        """Fold a batch's rows of one or more sources in; the buckets that were rewritten.

        ``batches`` maps ``listening``, ``social`` and ``video`` to rows that just arrived.
        Late rows lose to newer ones that are stored. An artist is listed once its listening
        row is there; what other sources said before is kept for then. Only the buckets of
        artists in the batch are read and written.
        """
        at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        # counted, folded and taken account of: each would compute the arrived rows again
        batches = {source: stored_once(batch, f"batch-{source}") for source, batch in batches.items()}
        previous = self._last(before=batch_id)
        places, _ = self._manifest(previous)
        keys = None
        for batch in batches.values():
            some = batch.select("artist_id").dropna()
            keys = some if keys is None else keys.unionByName(some)
        # at most one row per bucket
        touched = [] if keys is None else sorted(
            r["b"] for r in keys.select(_bucket(self.buckets).alias("b")).distinct().collect()
        )
        old = self._rows("state", self.schema, {b: places[b] for b in touched if b in places})
        state = old
        for source, batch in batches.items():
            state = self._folded(state, source, batch)
        state = state.withColumn("bucket", _bucket(self.buckets))
        here = f"version={batch_id}"
        if touched:
            state.repartition(min(len(touched), self.buckets), "bucket").write.mode(
                "overwrite"
            ).partitionBy("bucket").parquet(f"{self.path}/state/{here}")
            made = self._rows("state", self.schema, dict.fromkeys(touched, batch_id))
            self._scored(made).withColumn("bucket", _bucket(self.buckets)).repartition(
                min(len(touched), self.buckets), "bucket"
            ).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/scored/{here}")
            self._move_sums(previous, batch_id, batches, old, made)
        elif previous is not None:
            self.summary(previous).write.mode("overwrite").parquet(f"{self.path}/summary/{here}")
        places |= dict.fromkeys(touched, batch_id)
        listed = [(b, v, at.isoformat()) for b, v in sorted(places.items())] or [(None, None, at.isoformat())]
        self.spark.createDataFrame(listed, "bucket int, version bigint, at string").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{self.path}/manifest/{here}")
        return touched

    # --- sums ---------------------------------------------------------------------------

    def _facts(self, rows: DataFrame, sign: int) -> DataFrame:
        """One row per scored artist and report it counts in, to be added or taken away."""
        kinds = F.explode(F.array(
            F.struct(F.lit("genre").alias("kind"), F.col("primary_genre").alias("key")),
            F.struct(F.lit("growth").alias("kind"), F.col("growth_potential").alias("key")),
        ))
        one = F.lit(sign).cast("bigint")
        counted = lambda c: F.when(c, one).otherwise(F.lit(0).cast("bigint"))
        return rows.withColumn("in", kinds).select(
            "in.kind", "in.key", F.lit(None).cast("string").alias("detail"), one.alias("rows"),
            counted(F.col("artist_name").isNotNull()).alias("names"),
            counted(F.col("growth_potential") == "High").alias("high"),
            *[counted(F.col(m).isNotNull()).alias(f"n_{m}") for m in MEASURES],
            *[(F.coalesce(m, F.lit(0)).cast(EXACT) * sign).cast(EXACT).alias(f"sum_{m}") for m in MEASURES],
        )

    def _arrivals(self, batch_id: int, batches: Mapping[str, DataFrame]) -> DataFrame:
        """Rows that came per source, as further rows of the summary."""
        out = None
        for source, batch in batches.items():
            one = batch.agg(F.count("*").alias("rows")).select(
                F.lit("source").alias("kind"), F.lit(source).alias("key"),
                F.lit(str(batch_id)).alias("detail"), "rows",
            )
            out = one if out is None else out.unionByName(one)
        return out

    def _move_sums(
        self, previous: int | None, batch_id: int, batches: Mapping[str, DataFrame],
        old: DataFrame, made: DataFrame,
    ) -> None:
        """Take away what the artists of the rewritten buckets were and add what they became.

        Sums are exact, so those that did not change leave nothing, and no row is shuffled.
        """
        was = self._facts(self._scored(old), -1)
        now = self._facts(self._scored(made), 1)
        moved = was.unionByName(now).unionByName(
            self._arrivals(batch_id, batches), allowMissingColumns=True
        )
        if previous is not None:
            moved = moved.unionByName(self.summary(previous))
        sums = [c for c in moved.columns if c not in ("kind", "key", "detail")]
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(moved.schema[c].dataType)
        moved.groupBy("kind", "key", "detail").agg(*[total(c).alias(c) for c in sums]).where(
            "rows <> 0"
        ).write.mode("overwrite").parquet(f"{self.path}/summary/version={batch_id}")

    # --- upkeep -------------------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> None:
        """Remove what none of the newest ``keep`` versions refers to."""
        versions = self.versions()
        used: dict[int, set[int]] = {}
        for version in versions[-keep:]:
            for bucket, at in self._manifest(version)[0].items():
                used.setdefault(at, set()).add(bucket)
        for version in versions[:-keep]:
            remove_path(self.spark, f"{self.path}/manifest/version={version}")
            remove_path(self.spark, f"{self.path}/summary/version={version}")
        for kind in ("state", "scored"):
            for name in folder_names(self.spark, f"{self.path}/{kind}"):
                kept = used.get(int(name.partition("=")[2]), set())
                for bucket in folder_names(self.spark, f"{self.path}/{kind}/{name}"):
                    if int(bucket.partition("=")[2]) not in kept:
                        remove_path(self.spark, f"{self.path}/{kind}/{name}/{bucket}")


def _mean(measure: str) -> Column:
    return F.try_divide(F.col(f"sum_{measure}").cast("double"), F.col(f"n_{measure}"))


def kept_genre_summary(summary: DataFrame) -> DataFrame:
    """``genre_summary`` of the scored rows, from the kept sums."""
    return summary.where("kind = 'genre'").select(
        F.col("key").alias("primary_genre"), F.col("rows").alias("artist_count"),
        _mean("priority_score").alias("avg_priority_score"),
        _mean("underrated_ratio").alias("avg_underrated_ratio"),
        _mean("engagement_score").alias("avg_engagement"), F.col("high").alias("high_growth_count"),
        _mean("instagram_followers").alias("avg_instagram_followers"),
        _mean("lastfm_listeners").alias("avg_lastfm_listeners"),
    ).orderBy(F.col("avg_priority_score").desc_nulls_last(), "primary_genre")


def kept_growth_summary(summary: DataFrame) -> DataFrame:
    """``growth_summary`` of the scored rows, from the kept sums."""
    return summary.where("kind = 'growth' AND key IS NOT NULL").select(
        F.col("key").alias("growth_potential"), F.col("names").alias("artist_count"),
        _mean("priority_score").alias("mean_score"), _mean("underrated_ratio").alias("mean_ratio"),
    ).orderBy(F.col("mean_score").desc_nulls_last(), "growth_potential").select(
        "growth_potential", "artist_count",
        array_round(F.col("mean_score"), 2).alias("avg_priority_score"),
        array_round(F.col("mean_ratio"), 2).alias("avg_underrated_ratio"),
    )


def kept_source_counts(summary: DataFrame) -> DataFrame:
    """Rows per source and batch, and the change since the source's batch before."""
    counts = summary.where("kind = 'source'").select(
        F.col("key").alias("source"), F.col("detail").cast("bigint").alias("batch"),
        F.col("rows").alias("n"),
    )
    before = F.lag("n").over(Window.partitionBy("source").orderBy("batch"))
    return counts.withColumn("change", F.col("n") - before)

