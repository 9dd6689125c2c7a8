"""Ordered choice within groups: newest n, first, latest, distributed top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType


def first_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first n rows of each group under a total order.

    Filtering ``row_number`` lets Spark limit each group on the map side as well, so a
    group that holds a third of all rows sends at most n rows per task to the shuffle.
    """
    name = rank or "_position"
    out = df.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def spread_nulls(key: Column, unique: Column) -> Column:
    """Key for an outer join whose NULLs match nothing.

    Each NULL gets a value of its own that no real key has, so that they do not all meet
    in one shuffle partition.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), unique))


def lookup_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join a table that has one row per key; any share of the left rows may have one key.

    Adaptive execution splits a hot key's rows only between two plain shuffles, but a
    right side that was just grouped by the key would keep its partitioning instead. The
    key's hash as a further join column makes Spark shuffle both sides, at the price of
    moving the grouped (smaller) side once more. The right key is dropped.
    """
    probe = left.withColumn("_probe", F.xxhash64(left_key))
    build = right.withColumnRenamed(right_key, "_key").withColumn("_build", F.xxhash64("_key"))
    joined = probe.join(
        build, (F.col("_probe") == F.col("_build")) & (F.col(left_key) == F.col("_key")), how
    )
    return joined.drop("_probe", "_build", "_key")


#: Keys per block of a key filter: eight words of 64 bits, in each of which a key sets one bit.
FILTER_KEYS, FILTER_WORDS, WORD_BITS = 64, 8, 64


def _bit(probes: Column, word: int) -> Column:
    """The bit that a key sets in a word of its block: six bits of its second hash."""
    place = F.shiftright(probes, 6 * word).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _possible(df: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` without most of the rows that have none of about ``n`` keys, and without null ones.

    A Bloom filter of a byte a key is broadcast; of the rows without a wanted key one in
    thirty remains. Keys move as a block and a hash, not as texts.
    """
    blocks, words = -(-n // FILTER_KEYS), [f"_w{i}" for i in range(FILTER_WORDS)]
    block, probes = F.pmod(F.xxhash64(key), F.lit(blocks)), F.xxhash64(key, F.lit("bits"))
    filled = keys.select(block.alias("_block"), probes.alias("_probes")).repartition("_block").groupBy(
        "_block").agg(*[F.bit_or(_bit(F.col("_probes"), i)).alias(w) for i, w in enumerate(words)])
    fits = block == F.col("_block")
    for i, word in enumerate(words):
        fits &= F.col(word).bitwiseAND(_bit(probes, i)) != 0
    return df.where(F.col(key).isNotNull()).join(F.broadcast(filled), fits, "left_semi")


def only_wanted(
    df: DataFrame, wanted: DataFrame, key: str, wanted_key: str, most: int = 500_000,
    most_filtered: int = 1 << 26,
) -> DataFrame:
    """``df`` without rows that a later join on the key would drop, before any shuffle.

    Up to about ``most`` wanted keys are broadcast, so that a ranking of the rest still limits
    groups on the map side. Up to ``most_filtered``, a filter of them is broadcast, which
    lets a few other rows pass. With more, ``df`` is left as it is. The join that follows
    drops the others. ``wanted`` is read twice; pass a stored one.
    """
    keys = wanted.select(F.col(wanted_key).alias(key)).dropna()
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    if n > most_filtered:
        return df
    if n > most:
        return _possible(df, keys, key, n)
    return df.join(F.broadcast(keys.distinct()), key, "left_semi")


def first_hit_per_artist(hits: DataFrame) -> DataFrame:
    """Keep each artist's first discovery hit.

    Searches run one after the other: tags in their list's order, then the country chart;
    within a search, pages and hits in theirs. Tags that are not listed follow by name.
    """
    order = ("search_ord", "source", "query_ord", "hit_ord")
    return first_n_per_group(hits, ["artist_name"], [F.asc(c) for c in order], 1)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; maps, which have none, as text."""
    return F.xxhash64(*[
        F.to_json(c) if isinstance(f.dataType, MapType) else c
        for f in df.schema.fields for c in [F.col(f"`{f.name}`")]
    ])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key; ``order`` names ascending columns.

    Rows that tie in all of them are told apart by a hash of the whole row, so the choice
    does not depend on how the rows are split into files or tasks.
    """
    last = [F.col(c).desc_nulls_last() for c in order]
    return first_n_per_group(df, keys, [*last, row_hash(df).desc()], 1)


def latest_per_artist(
    df: DataFrame, order: Sequence[str] = ("collection_timestamp",)
) -> DataFrame:
    return latest_per_key(df, ["artist_id"], order)


def append_batch(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Existing rows plus a new batch, keeping the newest row per key.

    Rows of the batch win over equal-order rows already stored.
    """
    both = existing.withColumn("_arrival", F.lit(0)).unionByName(
        batch.withColumn("_arrival", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, keys, [*order, "_arrival"]).drop("_arrival")


def score_order() -> list[Column]:
    return [F.col("priority_score").desc_nulls_last(), F.asc("artist_id")]
