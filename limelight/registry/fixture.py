"""Artist-shaped inputs that Spark derives from the given tables.

An artist is a customer with orders, a post or an uploaded video is a line item, a track
is an order. FIXTURES.md section 2 lists the rules; ``oracle.py`` states them in SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import TABLE_GENRES
from ..functions.metrics import plays_per_listener
from ..functions.numeric import ratio
from ..operators.merge import merge_sources, stamp_collection
from ..operators.posts import post_means
from ..operators.songs import top_tracks
from ..session import stored_once

BATCH_TIME = dt.datetime(2024, 1, 31)
# the last two are searched for, but no scoring profile accepts them
GENRES = (*TABLE_GENRES, "british soul", "uk jazz")
# amounts of an upload, and the column of its line item that each is made of
AMOUNTS = {"views": "l_extendedprice", "likes": "l_extendedprice", "comments": "l_quantity"}
FILE_LINES = 250_000


def _amount(name: str) -> Column:
    source = F.col(AMOUNTS[name])
    if name == "comments":
        return source.cast("bigint").alias(name)
    return F.floor(source if name == "views" else source / 50).alias(name)


class Fixture:
    """Derived tables for one data directory; every table is built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored_lines: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.stored_lines = stored_lines

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with the key, name, genre and region of the artist they stand for."""
        genre = F.array(*[F.lit(g) for g in GENRES])
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("k"),
            F.col("c_name").alias("artist_name"),
            F.md5("c_name").alias("artist_id"),
            F.get(genre, F.col("c_nationkey") % len(GENRES)).alias("genre"),
            F.col("c_nationkey").alias("nation"), F.col("n_regionkey").alias("region"),
            F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """Order totals per customer."""
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        return self.orders.groupBy(F.col("o_custkey").alias("k")).agg(
            F.floor(F.min("o_totalprice")).alias("listeners"),
            F.call_function("div", F.sum(cents), F.lit(100)).alias("playcount"),
            F.count("*").alias("n_orders"),
        )

    @cached_property
    def artists(self) -> DataFrame:
        return self.customers.join(self.catalogue, "k")

    @cached_property
    def listening(self) -> DataFrame:
        listed = self.artists.select(
            "artist_id", "artist_name",
            F.col("listeners").alias("lastfm_listeners"),
            F.col("playcount").alias("lastfm_playcount"),
            plays_per_listener(F.col("playcount"), F.col("listeners"))
            .alias("lastfm_playcount_per_listener"),
            F.concat(F.lit("https://music.example/"), "artist_name").alias("lastfm_url"),
            F.col("genre").alias("genres"), F.col("genre").alias("primary_genre"),
            F.concat(F.lit("genre:"), "genre").alias("source"),
        )
        return stamp_collection(listed, BATCH_TIME).drop("last_updated")

    @property
    def _ordered(self) -> DataFrame:
        return self.orders.select("o_orderkey", F.col("o_custkey").alias("k"))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with their customer, as the numbers that uploads are made of.

        Texts are made of them after the last shuffle, not carried through it.
        """
        return self._lines(self._ordered) if self.stored_lines is None else self.stored_lines

    def _lines(self, orders: DataFrame, *amounts: str, titled: bool = False) -> DataFrame:
        """Line items of these orders; with ``amounts`` only those, made before the shuffle.

        Whole numbers take a fraction of the room of the prices that they are made of.
        With ``titled`` the names of their parts come along as a list; flag and status do not.
        """
        made = [_amount(a) for a in amounts if a != "comments"]
        if not amounts:
            made.append(F.col("l_extendedprice"))
        if not amounts or "comments" in amounts:
            made.append(F.col("l_quantity"))
        flags = () if titled else ("l_returnflag", "l_linestatus")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *flags,
            F.col("l_shipdate").cast("date").alias("day"), *made,
        )
        if titled:  # a list of names alone would lose null ones; stored, a hot part can be split
            names = F.transform(F.collect_list(F.struct("p_name")), lambda p: p["p_name"])
            parts = self.table("part").groupBy("p_partkey").agg(names.alias("parts"))
            lines = lines.join(
                stored_once(parts, "parts"), F.col("l_partkey") == F.col("p_partkey"), "left"
            ).drop("p_partkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    def kept(
        self, cluster: bool = True, amounts: Sequence[str] = (), titled: bool = False
    ) -> Fixture:
        """A fixture whose line items are joined once and stored, for jobs that use them often.

        The regions of the customers come along with the orders, as a list, so that repeated
        keys multiply only the rows they are asked for. With ``cluster`` a customer's lines
        lie together, so that what follows by customer, channel or profile is reduced before
        it is shuffled. With ``amounts`` the lines hold no other amounts than these. With
        ``titled`` they hold the names of their parts, for jobs that ask for titles more than
        once, but no flag and status. Files are small, so that a task that sorts the lines it
        reads has room for them.
        """
        regions = self.customers.groupBy("k").agg(
            F.collect_list(F.struct("region")).alias("regions")
        )
        lines = self._lines(self._ordered.join(regions, "k", "left"), *amounts, titled=titled)
        lines = stored_once(lines.repartition("k") if cluster else lines, "lines", FILE_LINES)
        return Fixture(self.spark, self.sf_dir, lines)

    def stored(self, *names: str) -> Fixture:
        """A fixture with these derived tables computed once and stored."""
        out = Fixture(self.spark, self.sf_dir)
        for name in names:
            setattr(out, name, stored_once(getattr(self, name), name))
        return out

    @cached_property
    def uploads(self) -> DataFrame:
        """Line items with their customer: the source of posts, videos and channels."""
        return self._uploads(self.lines)

    def _uploads(self, lines: DataFrame, *more: str) -> DataFrame:
        code = F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.date_format("day", "yyyyMMdd"),
        )
        have = lines.columns
        amounts = [
            F.col(name) if name in have else _amount(name)
            for name, source in AMOUNTS.items() if name in have or source in have
        ]
        channel = ()
        if "l_returnflag" in have:
            flags = ("l_returnflag", "l_linestatus")
            channel = (F.concat(F.lit("ch"), "k", *flags).alias("channel_id"), *flags)
        return lines.select(
            "k", "l_orderkey", "l_partkey", "l_linenumber", *channel, code.alias("code"), "day",
            *amounts, *more,
        )

    def _titled(self, lines: DataFrame) -> DataFrame:
        """Lines with the names of their parts."""
        if "parts" in lines.columns:
            return lines.select("*", F.explode("parts").alias("p_name"))
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        return lines.join(part, "l_partkey")

    def _feed(self, uploads: DataFrame, *more: Column) -> DataFrame:
        if "l_returnflag" in uploads.columns:
            more = ((F.col("l_returnflag") == "R").alias("is_video"), *more)
        return uploads.select(
            F.concat(F.lit("artist"), "k").alias("handle"), F.col("code").alias("shortcode"),
            F.col("day").alias("post_date"), "likes", "comments", *more,
        )

    @cached_property
    def posts(self) -> DataFrame:
        lines = self.stored_lines
        if lines is None:
            lines = self._lines(self._ordered, "likes", "comments")
        return self._feed(
            self._uploads(self._titled(lines), "p_name"), F.lower("p_name").alias("caption")
        )

    @cached_property
    def social_artists(self) -> DataFrame:
        return self._social(self.artists)

    def _social(self, customers: DataFrame) -> DataFrame:
        return customers.where((F.col("segment") != "MACHINERY") & (F.col("balance") >= 1))

    def _profile(self, df: DataFrame, handle: Column, full_name: Column, bio: Column) -> DataFrame:
        return df.select(
            handle.alias("handle"), full_name.alias("full_name"), bio.alias("biography"),
            F.floor(F.col("balance") * 15).alias("followers"),
            (F.col("nation") * 10).cast("bigint").alias("followees"),
            F.floor("balance").alias("mediacount"),
            (F.col("balance") > 5000).alias("is_verified"),
        )

    @cached_property
    def own_profiles(self) -> DataFrame:
        name, segment = F.col("artist_name"), F.col("segment")
        return self._profile(
            self.social_artists, F.concat(F.lit("artist"), "k"),
            F.when(segment == "BUILDING", F.upper(name))
            .when(segment == "FURNITURE", "The Band Page").otherwise("plain page"),
            F.when(segment == "AUTOMOBILE", F.concat(F.lit("by "), name)).when(
                segment != "HOUSEHOLD", "daily notes"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        guessed = self.social_artists.where(F.col("region") == 3)
        return self.own_profiles.unionByName(self._profile(
            guessed, F.concat(F.lower("artist_name"), F.lit("music")),
            F.col("artist_name"), F.lit(""),
        ))

    @property
    def _named(self) -> DataFrame:
        return self.social_artists.select(
            "artist_id", "artist_name", F.concat(F.lit("artist"), "k").alias("handle")
        ).join(self.own_profiles, "handle")

    @cached_property
    def social_handles(self) -> DataFrame:
        """Artist and handle of every row of ``social``: profiles that have posts."""
        posting = self.lines.select("k").distinct().select(
            F.concat(F.lit("artist"), "k").alias("handle")
        )
        return self._named.join(posting, "handle").select(
            "artist_id", F.col("handle").alias("instagram_handle")
        )

    @cached_property
    def social(self) -> DataFrame:
        """Social rows with the rate left unrounded."""
        lines = self.stored_lines
        if lines is None:  # lines that no row needs end at the first join
            orders = self._ordered.join(self._social(self.customers).select("k"), "k", "left_semi")
            lines = self._lines(orders, "likes", "comments")
        means = post_means(self._feed(self._uploads(lines)))
        rate = ratio(F.col("mean_likes") + F.col("mean_comments"), F.col("followers")) * 100
        return self._named.join(means, "handle").select(
            "artist_id", "artist_name", F.col("handle").alias("instagram_handle"),
            F.col("followers").alias("instagram_followers"),
            F.col("followees").alias("instagram_following"),
            F.col("mediacount").alias("instagram_posts"),
            F.col("mean_likes").alias("instagram_avg_likes"),
            F.col("mean_comments").alias("instagram_avg_comments"),
            rate.alias("instagram_engagement_rate"),
            F.col("reels").alias("instagram_reels_count"),
            F.col("is_verified").alias("instagram_verified"),
        )

    @cached_property
    def video(self) -> DataFrame:
        lines = self.stored_lines
        if lines is None:
            lines = self._lines(self._ordered, "views", "comments")
        totals = self._uploads(lines).groupBy("k").agg(
            (F.sum("comments") * 20).alias("subscribers"), F.sum("views").alias("total_views"),
        )
        busy = self.artists.where(F.col("n_orders") >= 8)
        return busy.join(totals, "k").select(
            "artist_id", "artist_name", F.concat(F.lit("chan"), "k").alias("youtube_channel_id"),
            F.col("subscribers").alias("youtube_subscribers"),
            F.col("total_views").alias("youtube_total_views"),
            F.col("n_orders").alias("youtube_video_count"),
            F.rint(ratio(F.col("total_views"), F.col("n_orders")))
            .alias("youtube_avg_views_per_video"),
        )

    @cached_property
    def raw(self) -> DataFrame:
        return merge_sources(self.listening, self.social, self.video, BATCH_TIME)

    @cached_property
    def arrivals(self) -> list[dict[str, DataFrame]]:
        """Three batches of source rows, some of them late; artists go by their number."""
        number = F.substring("artist_name", 10, 9).cast("bigint")
        start = F.lit(BATCH_TIME.isoformat(sep=" ")).cast("timestamp")

        def timed(df: DataFrame, hours: Column) -> DataFrame:
            return df.withColumn(
                "collection_timestamp", start + F.make_dt_interval(F.lit(0), hours.cast("int"))
            )

        more = F.col("lastfm_listeners") + 1000
        return [
            {
                "listening": timed(self.listening, number % 3),
                "social": timed(self.social.where(number % 4 != 1), F.lit(0)),
            },
            {
                "listening": timed(
                    self.listening.where(number % 2 == 0).withColumn("lastfm_listeners", more),
                    (number + 1) % 3),
                "video": timed(self.video, F.lit(0)),
            },
            {
                "social": timed(self.social.where(number % 3 == 0).withColumn(
                    "instagram_followers", F.col("instagram_followers") * 2), F.lit(1)),
                "listening": timed(self.listening.where(number % 5 == 0).withColumn(
                    "primary_genre", F.lit("jazz")), number % 4),
            },
        ]

    @cached_property
    def channels(self) -> DataFrame:
        totals = self.uploads.groupBy("k", "channel_id", "l_returnflag", "l_linestatus").agg(
            F.sum("views").alias("views"), F.count("*").alias("videos"),
        )
        name, region, flag = F.col("artist_name"), F.col("region"), F.col("l_returnflag")
        title = (
            F.when(flag == "A", F.concat(name, F.lit(" Official")))
            .when(flag == "N", name)
            .when(F.col("l_linestatus") == "F", "Official hits").otherwise("misc")
        )
        description = (
            F.when(region == 0, F.concat(
                F.lit("Official page of "), name, F.lit(" instagram.com/Artist"), "k",
                F.lit("?hl=en")))
            .when(region == 1, "Welcome")
            .when(region == 2, F.concat(F.lit("Contact IG: artist"), "k"))
            .when(region == 3, "Mail me at box@example.org")
            .otherwise(F.concat(F.lit("with @nobody and @artist"), "k"))
        )
        return totals.join(self.customers, "k").select(
            "artist_id", "channel_id", title.alias("title"), description.alias("description"),
            F.greatest(F.col("views") - 5000, F.lit(0)).alias("subscribers"), "views", "videos",
        )

    @cached_property
    def channel_search(self) -> DataFrame:
        """Search results per artist; flag and status give each channel its place."""
        place = F.concat("l_returnflag", "l_linestatus")
        rank = F.array_position(F.array(*[
            F.lit(f + s) for f in ("A", "N", "R") for s in ("F", "O")
        ]), place)
        return (
            self.uploads.select("k", "channel_id", rank.alias("search_rank")).distinct()
            .join(self.customers.select("k", "artist_id"), "k")
            .select("artist_id", "channel_id", "search_rank")
        )

    @cached_property
    def videos(self) -> DataFrame:
        description = F.when(
            F.col("region") == 1,
            F.concat(F.lit("Out now, follow @artist"), "k", F.lit("!")),
        ).otherwise(F.lower("p_name"))
        if "regions" in self.lines.columns:
            titled = self._titled(self.lines).select("*", F.inline("regions"))
        else:
            titled = self._titled(self.lines).join(self.customers.select("k", "region"), "k")
        uploads = self._uploads(titled, "p_name", "region")
        have = uploads.columns
        return uploads.select(
            *[c for c in ("channel_id",) if c in have], F.col("code").alias("video_id"),
            F.col("p_name").alias("title"), description.alias("description"),
            *[a for a in AMOUNTS if a in have],
            F.concat(F.col("day").cast("string"), F.lit("T00:00:00Z")).alias("published_at"),
        )

    @cached_property
    def chart(self) -> DataFrame:
        """Every order as a charting track; a higher price is a better rank."""
        parts = self.table("part")
        titles = parts.select(F.col("p_partkey").alias("title_key"), "p_name")
        n_parts = parts.agg(F.count("*")).scalar()
        handle = self.social_artists.select(
            "k", F.concat(F.lit("artist"), "k").alias("instagram_handle")
        )
        return (
            self.orders.withColumns({
                "title_key": F.col("o_orderkey") % n_parts, "k": F.col("o_custkey"),
            })
            .join(titles, "title_key")
            .join(self.customers.select("k", "artist_id", "artist_name"), "k")
            .join(handle, "k", "left")
            .select(
                F.concat(F.lit("tr"), "o_orderkey").alias("track_id"), "artist_id", "artist_name",
                F.initcap("p_name").alias("track_name"),
                F.floor("o_totalprice").alias("lastfm_playcount"),
                F.floor(F.col("o_totalprice") / 7).alias("lastfm_listeners"),
                F.concat(F.lit("https://music.example/track/"), "o_orderkey").alias("lastfm_url"),
                (F.lit(1_000_000) - F.floor("o_totalprice")).cast("int").alias("lastfm_rank"),
                F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
                .alias("release_date"),
                "instagram_handle",
            )
        )

    @cached_property
    def tracks(self) -> DataFrame:
        return top_tracks(self.chart)

    @cached_property
    def video_search(self) -> DataFrame:
        """Video search results per track: the line items of its order."""
        return self.uploads.select(
            F.concat(F.lit("tr"), "l_orderkey").alias("track_id"), F.col("code").alias("video_id"),
            F.col("l_linenumber").alias("search_rank"),
        )

    @cached_property
    def handle_text(self) -> DataFrame:
        """Whole documents, each with a mention of one kind appended."""
        handle = F.concat(F.lit("Artist"), "doc_id")
        kind = F.col("doc_id") % 7
        mention = (
            F.when(kind == 0, F.concat(F.lit(" instagram.com/"), handle, F.lit("?y")))
            .when(kind == 1, F.concat(F.lit(" @"), handle))
            .when(kind == 2, F.concat(F.lit(" IG: "), handle))
            .when(kind == 3, " a@b.com")
            .when(kind == 4, "")
            .when(kind == 5, F.concat(F.lit(" @"), handle, F.lit(" instagram "), handle,
                                      F.lit("_x")))
            .otherwise(F.concat(F.lit(" @"), handle, F.lit(".")))
        )
        return self.table("documents").select("doc_id", F.concat("text", mention).alias("text"))

    @cached_property
    def batches(self) -> DataFrame:
        """Events as collection batches: the user is the artist, the type its source."""
        return self.table("events").select(
            F.col("user_id").cast("string").alias("artist_id"), "event_id",
            F.col("event_type").alias("source"), F.col("ts").cast("date").alias("batch"),
            F.col("ts").cast("timestamp").alias("collection_timestamp"), "value",
        )

    @cached_property
    def log_lines(self) -> DataFrame:
        """One collection log line per event."""
        message = (
            F.when(F.col("event_type") == "error",
                   F.concat(F.lit("HTTP 4"), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"),
                            F.lit(" from source")))
            .when(F.col("event_type") == "signup", "Rate limit reached")
            .when(F.col("event_type") == "view", F.concat(F.lit("Running job "), "event_id"))
            .otherwise(F.concat(F.lit("collected "), "event_id"))
        )
        level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
        return self.table("events").select(F.concat(
            F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] ["), level,
            F.lit("] "), message,
        ).alias("value"), F.col("event_id").alias("line_ord"))

    @cached_property
    def attempts(self) -> DataFrame:
        """Channel lookups in collection order, one budget per year of order dates."""
        return self.orders.join(
            self.customers.select(F.col("k").alias("o_custkey"), "artist_id"), "o_custkey"
        ).select(
            F.trunc(F.col("o_orderdate").cast("date"), "year").alias("collection_date"),
            F.col("o_orderkey").alias("attempt_ord"), "artist_id",
            (F.col("o_orderstatus") != "P").alias("matched"),
            (F.col("o_orderstatus") == "F").alias("accepted"),
        )

    # --- landed payloads -------------------------------------------------------------

    def _hit_pages(self, artists: DataFrame, *by: str) -> DataFrame:
        """Search result pages: up to 100 neighbouring customers of a genre or country."""
        hit = F.struct(
            F.col("k"), F.col("artist_name").alias("name"),
            F.when(F.col("segment") != "MACHINERY", F.col("listeners").cast("string"))
            .alias("listeners"),
        )
        pages = artists.groupBy(*by, F.floor(F.col("k") / 100).alias("query_ord")).agg(
            F.array_sort(F.collect_list(hit)).alias("artist")
        )
        return pages.select(*by, "query_ord", F.to_json(
            F.struct(F.struct("artist").alias("topartists"))
        ).alias("body"))

    @cached_property
    def tag_payloads(self) -> DataFrame:
        return self._hit_pages(self.artists.withColumn("tag", F.col("genre")), "tag")

    @cached_property
    def chart_payloads(self) -> DataFrame:
        home = self.artists.join(
            self.table("nation").where(F.col("n_name") == "NATION_0"),
            F.col("nation") == F.col("n_nationkey"),
        )
        return self._hit_pages(home, "n_name").select("query_ord", "body")

    @cached_property
    def info_payloads(self) -> DataFrame:
        """Artist details; some lack tags, some lack an artist, some have broken numbers."""
        segment = F.col("segment")
        tags = F.when(segment != "HOUSEHOLD", F.array(
            F.struct(F.col("genre").alias("name")), F.struct(segment.alias("name")),
            *[F.struct(F.lit(f"tag{i}").alias("name")) for i in range(4)],
        ))
        artist = F.struct(
            F.upper("artist_name").alias("name"),
            F.when(F.col("region") != 1, F.concat(F.lit("https://music.example/"), "artist_name"))
            .alias("url"),
            F.struct(
                F.when((segment == "FURNITURE") & (F.col("balance") < 0), "n/a")
                .when(F.col("balance") >= 0, F.col("listeners").cast("string")).alias("listeners"),
                F.col("playcount").cast("string").alias("playcount"),
            ).alias("stats"),
            F.struct(tags.alias("tag")).alias("tags"),
        )
        missing = (segment == "MACHINERY") & (F.col("balance") < 0)
        body = F.when(missing, '{"error": 6}').otherwise(F.to_json(F.struct(artist.alias("artist"))))
        return self.artists.select(
            F.col("artist_name").alias("query_name"),
            F.concat(F.lit("genre:"), "genre").alias("source"), body.alias("body"),
        )

    @cached_property
    def track_payloads(self) -> DataFrame:
        """One chart of at most ten tracks per artist."""
        entry = F.struct(
            F.col("lastfm_rank"), F.col("track_id"), F.col("track_name").alias("name"),
            F.col("lastfm_playcount").cast("string").alias("playcount"),
            F.col("lastfm_listeners").cast("string").alias("listeners"),
            F.col("lastfm_url").alias("url"),
            F.struct(F.col("lastfm_rank").cast("string").alias("rank")).alias("@attr"),
        )
        charts = self.tracks.groupBy("artist_id").agg(
            F.array_sort(F.collect_list(entry)).alias("track")
        )
        return charts.select("artist_id", F.to_json(
            F.struct(F.struct("track").alias("toptracks"))
        ).alias("body"))

    @cached_property
    def channel_payloads(self) -> DataFrame:
        """One payload per artist with its (at most six) channels; some counts are broken."""
        text = lambda c: F.col(c).cast("string")
        item = F.struct(
            F.col("channel_id").alias("id"),
            F.struct("title", "description").alias("snippet"),
            F.struct(
                F.when(F.col("videos") > 1, text("subscribers")).alias("subscriberCount"),
                F.when(F.col("views") % 97 == 0, "n/a").otherwise(text("views"))
                .alias("viewCount"),
                text("videos").alias("videoCount"),
            ).alias("statistics"),
        )
        return self.channels.groupBy("artist_id").agg(
            F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("body")
        )

    @cached_property
    def video_payloads(self) -> DataFrame:
        """One payload per video lookup; some counts are broken."""
        text = lambda c: F.col(c).cast("string")
        item = F.struct(
            F.col("video_id").alias("id"),
            F.struct(
                "title",
                F.when(F.col("comments") > 1, F.col("published_at")).otherwise("soon")
                .alias("publishedAt"),
            ).alias("snippet"),
            F.struct(
                F.when(F.col("views") % 89 == 0, "n/a").otherwise(text("views"))
                .alias("viewCount"),
                F.when(F.col("comments") > 2, text("likes")).alias("likeCount"),
                text("comments").alias("commentCount"),
            ).alias("statistics"),
        )
        return self.videos.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("body"))
