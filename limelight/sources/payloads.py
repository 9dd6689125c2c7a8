"""Landed API payloads (one JSON text per row, column ``body``) to flat rows.

Numbers arrive as text. Every parser is a projection plus a generator over the arrays of
one payload: no shuffle, and malformed payloads give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import SEARCH_TAGS, TOP_TRACKS
from ..functions import metrics, text


def _count(value: Column) -> Column:
    """Whole number from text; missing counts 0, unparseable stays NULL."""
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(
        F.trim(value).try_cast("bigint")
    )


def _listed(counts: Column, name: str) -> Column:
    """A count of a map: absent counts 0, null and unparseable ones stay NULL."""
    absent = counts.isNull() | ~F.map_contains_key(counts, F.lit(name))
    return F.when(absent, F.lit(0).cast("bigint")).otherwise(
        F.trim(F.try_element_at(counts, F.lit(name))).try_cast("bigint")
    )


def _parsed(payloads: DataFrame, schema: str) -> DataFrame:
    """Payloads with their parsed body ``p``.

    The one-element array keeps filters on parsed fields above the parsing; pushed below
    it, they would parse the body once more per condition.
    """
    others = [c for c in payloads.columns if c != "body"]
    body = F.array(F.from_json("body", schema))
    return payloads.select(*others, F.explode(body).alias("p"))


#: Why a payload gives no row; the first that applies.
UNREADABLE, INCOMPLETE, BROKEN = "unreadable", "incomplete", "broken number"


def artist_info_fault(p: Column) -> Column:
    """Why a parsed artist payload is rejected, or NULL."""
    artist = p["artist"]
    numbers = (_listed(artist["stats"], "listeners"), _listed(artist["stats"], "playcount"))
    return (
        F.when(artist.isNull(), UNREADABLE)
        .when(artist["name"].isNull() | _unnamed_tag(artist), INCOMPLETE)
        .when(reduce(or_, [n.isNull() for n in numbers]), BROKEN)
    )


def top_tracks_fault(p: Column) -> Column:
    """Why a parsed track chart is rejected, or NULL."""
    track = p["toptracks"]["track"]
    return (
        F.when(track.isNull(), UNREADABLE)
        .when(F.exists(track, lambda t: t["name"].isNull()), INCOMPLETE)
        .when(F.exists(track, lambda t: (
            _count(t["playcount"]).isNull() | _count(t["listeners"]).isNull()
            | _count(t["@attr"]["rank"]).isNull()
        )), BROKEN)
    )


def channels_fault(p: Column) -> Column:
    """Why a parsed channel response is rejected, or NULL."""
    return (
        F.when(p["items"].isNull(), UNREADABLE)
        .when(F.exists(p["items"], lambda i: i["snippet"]["title"].isNull()), INCOMPLETE)
        .when(F.exists(p["items"], _broken("subscriberCount", "viewCount", "videoCount")), BROKEN)
    )


def videos_fault(p: Column) -> Column:
    """Why a parsed video response is rejected, or NULL."""
    return F.when(p["items"].isNull(), UNREADABLE).when(
        F.exists(p["items"], _broken("viewCount", "likeCount", "commentCount")), BROKEN
    )


def hits_fault(p: Column) -> Column:
    """Why a parsed search result is rejected, or NULL."""
    return F.when(p["topartists"]["artist"].isNull(), UNREADABLE)


#: Payload schema and fault of every kind of payload.
KINDS = {
    "tag_hits": (schemas.HITS_PAYLOAD, hits_fault),
    "geo_hits": (schemas.HITS_PAYLOAD, hits_fault),
    "artist_info": (schemas.ARTIST_PAYLOAD, artist_info_fault),
    "top_tracks": (schemas.TRACKS_PAYLOAD, top_tracks_fault),
    "channels": (schemas.CHANNELS_PAYLOAD, channels_fault),
    "videos": (schemas.VIDEOS_PAYLOAD, videos_fault),
}


def _unnamed_tag(artist: Column) -> Column:
    names = F.transform(_tags(artist), lambda t: t["name"])
    return F.coalesce(F.exists(metrics.genre_tags(names), F.isnull), F.lit(False))


def _tags(artist: Column) -> Column:
    """The tag list, NULL where it is none."""
    tag_text = artist["tags"]["tag"]
    return F.when(
        F.startswith(F.ltrim(tag_text), F.lit("[")), F.from_json(tag_text, schemas.TAG_LIST)
    )


def with_fault(payloads: DataFrame, kind: str) -> DataFrame:
    """Payloads with ``fault``: why their parser gives no row for them, NULL where it does.

    The body is parsed once, also when later steps filter on the fault.
    """
    schema, fault = KINDS[kind]
    parsed = F.array(F.from_json("body", schema))
    return payloads.select("*", F.explode(parsed).alias("_p")).select(
        *payloads.columns, F.explode(F.array(fault(F.col("_p")))).alias("fault")
    )


def accounted(payloads: DataFrame, kind: str, observation: Observation) -> DataFrame:
    """``payloads`` with their ``fault``, counted per cause as they pass.

    ``observation`` has ``payloads``, ``accepted`` and a count per cause once a job over the
    result has run: no pass of its own. One written table serves both ways: rows without a
    fault go on to the parser (``accepted``), the others are the rejects.
    """
    judged = with_fault(payloads, kind)
    counts = {UNREADABLE: "unreadable", INCOMPLETE: "incomplete", BROKEN: "broken_number"}
    return judged.observe(
        observation, F.count(F.lit(1)).alias("payloads"),
        F.count_if(F.col("fault").isNull()).alias("accepted"),
        *[F.count_if(F.col("fault") == cause).alias(name) for cause, name in counts.items()],
    )


def split_rejects(payloads: DataFrame, kind: str, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """(accepted payloads, rejected ones with their fault, counts), from one pass.

    The judged payloads are written below ``path`` by whether they have a fault, so either
    part is read without the other.
    """
    spark, seen = payloads.sparkSession, Observation()
    accounted(payloads, kind, seen).withColumn("rejected", F.col("fault").isNotNull()).write.mode(
        "overwrite"
    ).partitionBy("rejected").parquet(path)
    judged = spark.read.schema(
        T.StructType([*payloads.schema.fields, T.StructField("fault", T.StringType()),
                      T.StructField("rejected", T.BooleanType())])
    ).parquet(path)
    return (
        judged.where("NOT rejected").drop("fault", "rejected"),
        judged.where("rejected").drop("rejected"), seen.get,
    )


def _hits(payloads: DataFrame, source: Column, search_ord: Column) -> DataFrame:
    return (
        _parsed(payloads, schemas.HITS_PAYLOAD).select(
            source.alias("source"), search_ord.cast("int").alias("search_ord"), "query_ord",
            F.posexplode("p.topartists.artist").alias("hit_ord", "hit"),
        )
        .select(
            F.coalesce("hit.name", F.lit("")).alias("artist_name"),
            F.coalesce(_count(F.col("hit.listeners")), F.lit(0)).alias("lastfm_listeners"),
            "source", "search_ord", "query_ord", "hit_ord",
        )
    )


def parse_tag_hits(payloads: DataFrame, tags: Sequence[str] = SEARCH_TAGS) -> DataFrame:
    """Tag-search payloads (tag, query_ord, body): one row per artist hit.

    ``search_ord`` is the tag's place in ``tags``; those that are not listed come after.
    """
    place = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    search_ord = F.when(place > 0, place - 1).otherwise(F.lit(len(tags)))
    return _hits(payloads, F.concat(F.lit("genre:"), F.col("tag")), search_ord)


def parse_geo_hits(payloads: DataFrame, after: int = len(SEARCH_TAGS) + 1) -> DataFrame:
    """Country-chart payloads (query_ord, body): one row per artist hit.

    ``after`` is the chart's place among the searches, behind all tags.
    """
    return _hits(payloads, F.lit("uk_top"), F.lit(after))


def parse_artist_info(payloads: DataFrame) -> DataFrame:
    """Artist-detail payloads (query_name, source, body) to listening rows.

    Payloads without an artist or its name, or with null or unparseable numbers, give no
    row; an absent number counts 0. A tag list that is not a list counts as empty.
    """
    artist = F.col("p.artist")
    tag_names = F.transform(_tags(artist), lambda t: t["name"])
    fields = F.struct(
        artist["name"].alias("artist_name"),
        _listed(artist["stats"], "listeners").alias("lastfm_listeners"),
        _listed(artist["stats"], "playcount").alias("lastfm_playcount"),
        F.coalesce(artist["url"], F.lit("")).alias("lastfm_url"),
        metrics.genre_tags(tag_names).alias("genre_tags"),
    )
    complete = (
        F.col("artist_name").isNotNull()
        & F.col("lastfm_listeners").isNotNull() & F.col("lastfm_playcount").isNotNull()
        & ~F.exists("genre_tags", F.isnull)
    )
    rows = _parsed(payloads, schemas.ARTIST_PAYLOAD).select(
        "query_name", "source", F.inline(F.array(fields))
    ).where(complete)
    return rows.select(
        metrics.artist_id(F.col("query_name")).alias("artist_id"),
        "query_name", "artist_name", "lastfm_listeners", "lastfm_playcount",
        metrics.plays_per_listener(
            F.col("lastfm_playcount"), F.col("lastfm_listeners")
        ).alias("lastfm_playcount_per_listener"),
        "lastfm_url", "genre_tags",
        F.array_join("genre_tags", ", ").alias("genres"),
        metrics.primary_genre(F.col("genre_tags")).alias("primary_genre"),
        "source",
    )


def parse_top_tracks(payloads: DataFrame, limit: int = TOP_TRACKS) -> DataFrame:
    """Track-chart payloads (artist_id, body): the first ``limit`` tracks of each chart.

    One track without a name or with an unparseable number, wherever it stands, voids its
    whole payload. The default limit is what the collection step asks the service for.
    """
    parsed = _parsed(payloads, schemas.TRACKS_PAYLOAD).select(
        "artist_id", F.col("p.toptracks.track").alias("track")
    )
    broken = F.exists("track", lambda t: (
        t["name"].isNull() | _count(t["playcount"]).isNull() | _count(t["listeners"]).isNull()
        | _count(t["@attr"]["rank"]).isNull()
    ))
    return (
        parsed.where(~broken)
        .select("artist_id", F.posexplode(F.slice("track", 1, limit)).alias("chart_ord", "t"))
        .select(
            "artist_id", "chart_ord",
            F.col("t.name").alias("track_name"),
            _count(F.col("t.playcount")).alias("lastfm_playcount"),
            _count(F.col("t.listeners")).alias("lastfm_listeners"),
            F.coalesce("t.url", F.lit("")).alias("lastfm_url"),
            _count(F.col("t")["@attr"]["rank"]).cast("int").alias("lastfm_rank"),
        )
    )


def _items(payloads: DataFrame, schema, broken: Callable[[Column], Column]) -> DataFrame:
    """Items ``i`` of payloads that hold no broken one."""
    parsed = _parsed(payloads, schema).select(F.col("p.items").alias("items"))
    return parsed.where(~F.exists("items", broken)).select(F.explode("items").alias("i"))


def _broken(*counts: str) -> Callable[[Column], Column]:
    """Whether one of an item's counts is there but no number."""
    def check(item: Column) -> Column:
        return reduce(or_, [_listed(item["statistics"], name).isNull() for name in counts])
    return check


def parse_channels(payloads: DataFrame) -> DataFrame:
    """Channel payloads: identity, lower-case text and counts.

    A channel without a title or with an unparseable count voids its whole response.
    """
    counts = _broken("subscriberCount", "viewCount", "videoCount")
    return _items(
        payloads, schemas.CHANNELS_PAYLOAD, lambda i: i["snippet"]["title"].isNull() | counts(i)
    ).select(
        F.col("i.id").alias("channel_id"),
        F.lower("i.snippet.title").alias("title"),
        F.lower(F.coalesce("i.snippet.description", F.lit(""))).alias("description"),
        _listed(F.col("i.statistics"), "subscriberCount").alias("subscribers"),
        _listed(F.col("i.statistics"), "viewCount").alias("views"),
        _listed(F.col("i.statistics"), "videoCount").alias("videos"),
    )


def parse_videos(payloads: DataFrame) -> DataFrame:
    """Video payloads: identity, counts, publication date and link.

    A video is looked up alone; an unparseable count gives no video.
    """
    counts = _broken("viewCount", "likeCount", "commentCount")
    return _items(payloads, schemas.VIDEOS_PAYLOAD, counts).select(
        F.col("i.id").alias("video_id"),
        F.coalesce("i.snippet.title", F.lit("")).alias("title"),
        _listed(F.col("i.statistics"), "viewCount").alias("views"),
        _listed(F.col("i.statistics"), "likeCount").alias("likes"),
        _listed(F.col("i.statistics"), "commentCount").alias("comments"),
        text.published_date(F.col("i.snippet.publishedAt")).alias("published_date"),
        text.video_url(F.col("i.id")).alias("url"),
    )
