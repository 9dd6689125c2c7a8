"""Filters of stored keys: which batch folders can hold a key, without reading them.

A folder's filter lies in the folder itself, below ``_keys``, hidden from readers, so both
are replaced and removed together. It is a table of blocks of 512 bits: a key's hash names
its block and six bits in it, set by ``bit_or`` aggregates. A key whose bits are not all set
is not in the folder; one key in a hundred looks as if it were, so what the filters leave
over is looked up in the folders themselves, newest first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import path_exists, stored_once

WORDS, BITS = 8, 64
PROBES = 6
KEYS_PER_BLOCK = 40  # 12.8 bits a key
#: Filters have 2^n blocks, so that a block is a prefix of the key's hash.
LARGEST = 32


def _hashes(keys: Sequence[str]) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.xxhash64(*keys, F.lit("probes"))


def _block(hashed: Column, size: Column) -> Column:
    """The first ``size`` bits of a hash."""
    return F.when(size == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", hashed, (F.lit(64) - size).cast("int"))
    )


def _masks(probes: Column) -> list[Column]:
    """The bits that a key sets in each word of its block."""
    places = [F.shiftright(probes, 9 * i).bitwiseAND(F.lit(511)) for i in range(PROBES)]
    one = F.lit(1).cast("bigint")
    masks = []
    for word in range(WORDS):
        mask = F.lit(0).cast("bigint")
        for place in places:
            bit = F.call_function("shiftleft", one, (place % BITS).cast("int"))
            mask = mask.bitwiseOR(F.when(F.floor(place / BITS) == word, bit).otherwise(F.lit(0)))
        masks.append(mask)
    return masks


def write_filter(rows: DataFrame, keys: Sequence[str], folder: str) -> None:
    """Write the filter of a folder's rows into the folder."""
    distinct = rows.select(*keys).distinct()
    n = distinct.count()
    size = min(LARGEST, max(0, (n - 1) // KEYS_PER_BLOCK).bit_length())
    hashed, probes = _hashes(keys)
    bits = distinct.select(_block(hashed, F.lit(size)).alias("block"), *[
        m.alias(f"w{i}") for i, m in enumerate(_masks(probes))
    ])
    bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]).select(
        F.lit(size).alias("size"), "*"
    ).write.mode("overwrite").parquet(f"{folder}/_keys")


def may_hold(
    spark: SparkSession, wanted: DataFrame, keys: Sequence[str], folders: Mapping[int, str]
) -> DataFrame:
    """(keys..., folder): the folders that a key is possibly in, by their filters alone.

    ``wanted`` has distinct keys; null ones are nowhere. A folder without a filter may hold
    any key. Filters are
    read, about a byte and a half for each stored key, and met by block; a key travels once
    per size of filter, not once per folder.
    """
    wanted = wanted.select(*keys).dropna(subset=list(keys))
    filtered = {n: f for n, f in folders.items() if path_exists(spark, f"{f}/_keys")}
    others = F.array(*[F.lit(n).cast("bigint") for n in folders if n not in filtered])
    unknown = wanted.withColumn("folder", F.explode(others.cast("array<bigint>")))
    if not filtered:
        return unknown
    possible = _numbered(spark, [f"{f}/_keys" for f in filtered.values()])
    hashed, probes = _hashes(keys)
    sizes = [r["size"] for r in possible.select("size").distinct().collect()]  # one per power of two
    probing = wanted.select(*keys, hashed.alias("_h"), *[
        m.alias(f"m{i}") for i, m in enumerate(_masks(probes))
    ]).withColumn("_size", F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<int>")))
    probing = probing.withColumn("_block", _block(F.col("_h"), F.col("_size")))
    matches = (F.col("_size") == F.col("size")) & (F.col("_block") == F.col("block"))
    for i in range(WORDS):
        matches &= F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}")
    return probing.join(possible, matches).select(*keys, "folder").unionByName(unknown)


def _numbered(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of all paths with the number of the batch folder they lie in, -1 in others."""
    number = F.regexp_extract("_metadata.file_path", r"/batch_id=(\d+)/", 1)
    return spark.read.parquet(*paths).withColumn(
        "folder", F.coalesce(number.try_cast("bigint"), F.lit(-1).cast("bigint"))
    )


def known_keys(
    spark: SparkSession, wanted: DataFrame, keys: Sequence[str], folders: Mapping[int, str],
    visited: list[int] | None = None,
) -> DataFrame:
    """The distinct ``wanted`` keys that some folder holds; exact.

    Each round looks a key up in the newest folder that may hold it, and reads the keys of
    those folders only; false positives go on to the next folder. Folders that the filters
    rule out for all keys are never read. ``visited`` gets the numbers of those read. Folders
    are named ``batch_id=N`` with their number; a snapshot has any name and number -1.
    """
    left = stored_once(may_hold(spark, wanted, keys, folders), "may-hold")
    found = None
    while True:
        newest = left.groupBy(*keys).agg(F.max("folder").alias("folder"))
        numbers = sorted(r["folder"] for r in newest.select("folder").distinct().collect())
        if not numbers:
            break
        if visited is not None:
            visited += numbers
        stored = _numbered(spark, [folders[n] for n in numbers]).select(*keys, "folder")
        hits = stored_once(newest.join(stored, [*keys, "folder"], "left_semi"), "known").select(*keys)
        found = hits if found is None else found.unionByName(hits)
        # keys still open, without the folder just read
        left = stored_once(
            left.join(newest, [*keys, "folder"], "left_anti").join(hits, list(keys), "left_anti"),
            "may-hold",
        )
    return found if found is not None else wanted.select(*keys).where(F.lit(False))
