"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

A source's documents, shuffled, stand in a queue of their own, once per allowed repeat. A
piece's virtual finish time is the words its source has handed out up to its end, divided
by the source's target: what a server reaches that serves all queues at once, each at a
speed in proportion to its target. Sorted by finish times, the pieces make up the mix, cut
off at the total budget; a document in service at that moment gives its first words.

No queue goes through one task. Each is cut at its shuffled order into ranges of bounded
rows, whose sums are added up before rows are numbered within them; the global sort does
the same with finish times, among which words lie evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import quoted, stored

WORD = r"[^\x20\x09-\x0D]+"
#: What makes rows alike: they may change places in a queue without changing the mix.
ALIKE = ("place", "id", "size", "digest")
#: Copies of one row that are written out at a time.
CHUNK = 4096


def words_in(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a whole text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, repeats: int = 2
) -> DataFrame:
    """(source, source_size, place, target) of (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating, and share ``share``
    times all words. A target stops at ``repeats`` times its source; what is above is shared
    by the others by weight, until none is above. That water level is found in one pass over
    the sources by how soon they stop: it is the highest of the levels that hold when all
    before a source have stopped. One row per source goes through one task.
    """
    ranked = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumns({
        "weight": F.get(F.array(*[F.lit(w) for w in weights]), F.col("place") % len(weights)),
        "most": F.col("source_size") * repeats,
    })
    soon = Window.orderBy(F.col("most").cast("double") / F.col("weight"), "place")
    everything = Window.partitionBy()
    stopped = F.coalesce(
        F.sum("most").over(soon.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).cast("double")
    running = F.sum("weight").over(soon.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything).cast("double") * F.lit(float(share))
    return ranked.withColumn("here", (budget - stopped) / running).withColumn(
        "level", F.max("here").over(everything)
    ).select(
        "source", "source_size", "place",
        F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")).alias("target"),
    )


def _running(value: str, *order: str, by: Sequence[str] = ()) -> Column:
    """Sum of ``value`` over the rows before a row."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("bigint")


def _queues(
    spark: SparkSession, keys: DataFrame, targets: DataFrame, range_rows: int
) -> DataFrame:
    """A row per document with ``start``, the words of its source before it.

    ``keys`` has one row for all rows that are alike, ``n`` says how many; each of them comes
    out, numbered by ``copy``.
    """
    counted = keys.agg(F.count("*").alias("rows"), F.max("n").alias("most")).first()
    bits = min(31, ((counted["rows"] or 0) // range_rows).bit_length())
    shuffled = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    head = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("bigint")
    rows = keys.join(
        targets, keys["source"].eqNullSafe(targets["source"])
    ).select(
        *ALIKE, "n", "source_size", "target", shuffled.alias("shuffled"),
        (F.col("n") * F.col("size")).alias("words"),
    ).withColumn("range", F.shiftright(head, 32 - bits))
    ranges = rows.groupBy("place", "range").agg(F.sum("words").alias("in_range")).select(
        "place", "range", _running("in_range", "range", by=["place"]).alias("before")
    )
    within = _running("words", "shuffled", "id", "size", "digest", by=["place", "range"])
    lined = rows.withColumn("within", within).join(ranges, ["place", "range"])
    lined = lined.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(CHUNK))))
    if (counted["most"] or 0) > CHUNK:  # the copies of one row are spread over tasks
        lined = lined.repartition(spark.sparkContext.defaultParallelism * 4)
    last = F.least(F.col("first") + CHUNK, F.col("n")) - 1
    return lined.withColumn("copy", F.explode(F.sequence("first", last))).select(
        *ALIKE, "copy", "source_size", "target",
        (F.col("before") + F.col("within") + F.col("copy") * F.col("size")).alias("start"),
    )


def schedule(
    spark: SparkSession, docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
    repeats: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    range_rows: int = 20_000,
) -> DataFrame:
    """The mix: one row per document and repeat, also of those it does without.

    Columns: place (of the source in code point order), id, size (words), digest (of the
    text), copy (numbers rows that are alike), repeat (from 0), source_size, target, words
    (the first so many are taken), finish (virtual time, 0 to 1) and position (of the first
    word in the whole mix, gapless); finish and position are null where no word is taken.

    Every source's words sum up to its target, rounded down; a document is repeated only
    after all of its source were taken, and at most ``repeats`` times. Null texts have no
    words and are never taken. Null is a source of its own, null ids are carried. The order
    depends on ids, sizes and texts alone, so every run gives the same mix; alike rows are
    taken one by one. Other columns are not read, whatever their names. An empty table
    gives no rows.
    """
    text = quoted(text_col)
    rows = docs.select(
        quoted(id_col).alias("id"), quoted(source_col).alias("source"),
        words_in(text).alias("size"), F.xxhash64(text).alias("digest"),
    )
    keys = stored(spark, rows.groupBy("id", "source", "size", "digest").agg(
        F.count("*").alias("n")
    ), "mix-keys")
    sizes = keys.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = stored(spark, source_targets(sizes, weights, share, repeats), "mix-targets")
    queued = stored(spark, _queues(spark, keys, targets, range_rows), "mix-queues")
    offered = queued.withColumn(
        "repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)]))
    ).withColumn("start", F.col("start") + F.col("repeat") * F.col("source_size"))
    left = F.floor("target") - F.col("start")
    offered = offered.withColumn("words", F.greatest(F.lit(0), F.least("size", left)).cast("bigint"))
    served = offered.where("words > 0").withColumn(
        "finish", (F.col("start") + F.col("words")) / F.col("target")
    )
    total = targets.agg(
        F.sum("source_size").cast("double") * F.lit(float(share))
    ).first()[0] or 0.0
    parts = max(1, repeats * queued.count() // range_rows)
    ranged = served.withColumn(
        "range", F.least(F.floor(F.col("finish") * parts), F.lit(parts - 1))
    )
    ranges = ranged.groupBy("range").agg(F.sum("words").alias("in_range")).select(
        "range", _running("in_range", "range").alias("before")
    )
    order = ("finish", "place", "start")
    sorted_ = ranged.withColumn("within", _running("words", *order, by=["range"])).join(
        ranges, "range"
    ).withColumn("position", F.col("before") + F.col("within"))
    columns = (*ALIKE, "copy", "repeat", "source_size", "target")
    # what lies behind the budget is not taken
    room = F.greatest(F.lit(0), F.least("words", F.floor(F.lit(total)) - F.col("position")))
    taken = sorted_.select(*columns, room.cast("bigint").alias("words"), "finish", "position")
    idle = offered.where("words = 0").select(
        *columns, "words", F.lit(None).cast("double").alias("finish"),
        F.lit(None).cast("bigint").alias("position"),
    )
    return taken.unionByName(idle)


def per_document(pieces: DataFrame) -> DataFrame:
    """A schedule's rows summed per document: what all its repeats give to the mix."""
    return pieces.groupBy(*ALIKE, "copy", "source_size", "target").agg(
        F.sum("words").alias("taken"), F.min("position").alias("first_position")
    )


def mixed_texts(
    docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(position, id, repeat, words, text) of what a schedule takes, ordered by position.

    A text taken in part is its first words, joined by single spaces; others are unchanged.
    """
    text = quoted(text_col)
    texts = docs.select(quoted(id_col).alias("id"), text.alias("text")).withColumn(
        "digest", F.xxhash64("text")
    ).groupBy("id", "digest").agg(F.first("text").alias("text"))
    wanted = pieces.where("words > 0").alias("p")
    same = F.col("p.id").eqNullSafe(F.col("t.id")) & (F.col("p.digest") == F.col("t.digest"))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("words").cast("int")), " ")
    return wanted.join(texts.alias("t"), same).select(
        "position", F.col("p.id").alias("id"), "repeat", "words",
        F.when(F.col("words") < F.col("size"), head).otherwise(F.col("text")).alias("text"),
    ).orderBy("position")
