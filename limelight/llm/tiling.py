"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a window of words (a seed, found by Karp-Rabin
hashes) are compared by tiling: the longest match of unmarked words is marked in both,
again and again, until none of at least a window's length is left. The share of an item's
words that are marked tells whether the document holds it, in whatever order its passages
stand.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from .common import add_columns, map_batches, quoted, stored, without, words_pattern

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)  # odd: every power is invertible modulo 2^64

HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("matched", T.IntegerType()),
    T.StructField("item_words", T.IntegerType()), T.StructField("coverage", T.DoubleType()),
    T.StructField("tiles", T.ArrayType(T.StructType([
        T.StructField("doc_start", T.IntegerType()), T.StructField("item_start", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
    ]))),
]))


# --- words and windows -----------------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; null has none."""
    return words_pattern().findall(text.lower()) if text else []


@lru_cache(maxsize=1 << 16)
def _code(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8"), 7) or 1


def codes_of(text: str | None) -> np.ndarray:
    """A 64-bit code of every word."""
    words = words_of(text)
    return np.fromiter(map(_code, words), np.uint64, len(words))


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` codes, modulo 2^64."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * BASE + codes[k:k + n]
    return out


# --- tiling ----------------------------------------------------------------------------


def maximal_matches(a: np.ndarray, b: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of all matches of ``width`` or more codes that can't
    be extended. Windows are compared by hash, then by their codes.

    Goes through b's windows; the matches that run on are one array over a's places, so
    memory is bounded by the matches that end and one row of a.
    """
    hashes_a, hashes_b = window_hashes(a, width), window_hashes(b, width)
    order = np.argsort(hashes_a, kind="stable")
    ordered = hashes_a[order]
    found: list[tuple[int, int, int]] = []
    places, starts = np.empty(0, np.int64), np.empty(0, np.int64)
    for j in range(len(hashes_b) + 1):
        if j < len(hashes_b):
            low, high = np.searchsorted(ordered, hashes_b[j]), np.searchsorted(ordered, hashes_b[j], "right")
            now = np.sort(order[low:high])
            for k in range(width):
                now = now[a[now + k] == b[j + k]]
        else:
            now = np.empty(0, np.int64)
        at = np.searchsorted(now, places + 1)
        goes_on = np.zeros(len(places), bool)
        inside = at < len(now)
        goes_on[inside] = now[at[inside]] == places[inside] + 1
        for place, start in zip(places[~goes_on].tolist(), starts[~goes_on].tolist()):
            length = place - start + width
            found.append((start, j - 1 + width - length, length))
        begun = now.copy()
        begun[at[goes_on]] = starts[goes_on]
        places, starts = now, begun
    return found


def tiles(a: np.ndarray, b: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of a and b: non-overlapping matches, the longest first.

    Ties go to the smaller place in a, then in b. A match partly marked meanwhile goes
    back with the stretches of it that are still unmarked in both.
    """
    heap = [(-n, i, j) for i, j, n in maximal_matches(a, b, width)]
    heapq.heapify(heap)
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = free_a[i:i + n] & free_b[j:j + n]
        if free.all():
            free_a[i:i + n] = free_b[j:j + n] = False
            out.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.r_[False, free, False].astype(np.int8)))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s >= width:
                heapq.heappush(heap, (s - e, i + s, j + s))
    return out


def islands(codes: np.ndarray, seeded: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that seeds cover, a gap of one between islands, and their places (-1: gap).

    No match of ``width`` codes reaches outside, so tiling them gives the same tiles.
    """
    covered = np.zeros(len(codes), bool)
    for k in range(width):
        covered[seeded + k] = True
    places = np.flatnonzero(covered)
    breaks = np.flatnonzero(np.diff(places) > 1) + 1
    places = np.insert(places, breaks, -1)
    picked = np.where(places >= 0, codes[places], np.uint64(0))  # 0 is no word's code
    return picked, places


def hits_of(
    codes: np.ndarray, seeded: np.ndarray, items: list[tuple[int, np.ndarray]], width: int,
    min_coverage: float,
) -> list[dict]:
    """Items that a document covers, from the places of its seeds."""
    picked, places = islands(codes, seeded, width)
    out = []
    for item_id, item in items:
        found = tiles(picked, item, width)
        matched = sum(n for _, _, n in found)
        if matched >= min_coverage * len(item):
            out.append({
                "item_id": item_id, "matched": matched, "item_words": len(item),
                "coverage": matched / len(item),
                "tiles": [
                    {"doc_start": int(places[i]), "item_start": j, "length": n}
                    for i, j, n in sorted(found)
                ],
            })
    return sorted(out, key=lambda h: h["item_id"])


# --- documents against a benchmark ---------------------------------------------------


class Benchmark:
    """Items in memory: codes of each, and which items hold a seed."""

    def __init__(self, items: list[tuple[int, str]], width: int) -> None:
        self.width = width
        self.items = {i: codes_of(t) for i, t in items}
        pairs = [
            np.stack([h, np.full(len(h), i, np.uint64)], axis=1)
            for i, c in self.items.items() if len(h := window_hashes(c, width))
        ]
        every = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.uint64)
        self.seeds, self.owners = every[:, 0], every[:, 1].astype(np.int64)
        self.codes = {w: _code(w) for _, t in items for w in words_of(t)}

    def hits(self, text: str | None, min_coverage: float) -> list[dict]:
        words = words_of(text)
        # a word of no item is 0 and breaks every window it lies in
        codes = np.fromiter((self.codes.get(w, 0) for w in words), np.uint64, len(words))
        hashes = window_hashes(codes, self.width)
        if not len(hashes) or not len(self.seeds):
            return []
        low = np.searchsorted(self.seeds, hashes)
        hit = self.seeds[np.minimum(low, len(self.seeds) - 1)] == hashes
        gaps = np.r_[0, np.cumsum(codes == 0)]
        hit &= gaps[self.width:] == gaps[:len(hashes)]
        seeded = np.flatnonzero(hit)
        if not len(seeded):
            return []
        asked = np.unique(hashes[seeded])
        owners = np.unique(np.concatenate([
            self.owners[s:e] for s, e in zip(
                np.searchsorted(self.seeds, asked), np.searchsorted(self.seeds, asked, "right")
            )
        ]))
        return hits_of(
            codes, seeded, [(int(i), self.items[int(i)]) for i in owners], self.width, min_coverage
        )


def with_hits(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = 5, min_coverage: float = 0.8,
    broadcast_bytes: int = 32 << 20, out: str = "hits",
) -> DataFrame:
    """``docs`` with the benchmark items each whole text holds, an array in column ``out``.

    An item is held when tiles of at least ``width`` words cover ``min_coverage`` of its
    words. Each hit has item_id, matched and item_words, coverage, and the tiles (first word
    in the document and in the item, length). Items of fewer than ``width`` words give no
    evidence and are never held; null and empty texts hold nothing; items that repeat a
    text are found each; of items that repeat an id one is compared (the smallest text).
    Repeated rows get equal hits; a column named ``out`` is replaced, others pass through;
    an empty table on either side gives no hits. Item ids are integers; a benchmark with
    others is refused.

    A benchmark whose texts have at most ``broadcast_bytes`` in all is sent to every task,
    and documents are not moved. A larger one is joined by seed: see ``_joined_hits``.
    """
    ids = benchmark.select(quoted(item_id)).schema[0].dataType
    if not isinstance(ids, (T.IntegralType, T.NullType)):
        raise ValueError(f"item ids must be integers; {item_id} is {ids.simpleString()}")
    items = benchmark.select(
        quoted(item_id).cast("bigint").alias("item_id"), quoted(item_text).alias("item_text")
    ).where("item_id IS NOT NULL AND item_text IS NOT NULL").groupBy("item_id").agg(
        F.min("item_text").alias("item_text")
    )
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    if size > broadcast_bytes:
        return _joined_hits(spark, docs, items, text, width, min_coverage, out)
    shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in items.collect()])

    def factory():
        known = Benchmark(shared.value, width)

        def compute(column: pa.Array):
            return [[known.hits(v.as_py(), min_coverage) for v in column]]
        return compute

    return add_columns(docs, [text], T.StructType([T.StructField(out, HITS)]), factory)


def _seeds(rows: DataFrame, width: int, kind: str, each: bool = False) -> DataFrame:
    """(key, seed): the distinct seeds of every row of (key, text); ``each``: of every window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                made = [window_hashes(codes_of(v.as_py()), width) for v in part.column(1)]
                if not each:
                    made = [np.unique(m) for m in made]
                take = np.repeat(np.arange(len(made)), [len(m) for m in made])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(take)), pa.array(np.concatenate(made).view(np.int64))],
                    names=["key", "seed"],
                )

    return map_batches(rows, run, f"key {kind}, seed bigint")


def _candidate_pairs(
    spark: SparkSession, texts: DataFrame, items: DataFrame, width: int, min_coverage: float
) -> DataFrame:
    """(key, item_id): texts (key, text) that may hold an item (item_id, item_text), once each.

    A tile of n words covers n - width + 1 windows of the item, and tiles have ``width`` words
    at least, so tiles of m words cover m / width windows or more. A text without that many
    of the item's windows can't reach the coverage. So an item is looked up by its rarest
    seeds only: its most frequent ones may stay out as long as their windows are fewer than
    it needs, since a text that shares none of the others has too few. A seed that is hot
    in texts and items meets no pair but those it could decide alone.
    """
    item_seeds = stored(spark, _seeds(
        items.select(F.col("item_id").alias("key"), "item_text"), width, "bigint", each=True
    ), "tiling-item-seeds")
    asked = item_seeds.select("seed").distinct()
    shared = stored(spark, _seeds(
        texts.select("key", "text"), width, "string"
    ).join(asked, "seed", "left_semi"), "tiling-shared")
    frequency = shared.groupBy("seed").agg(F.count("*").alias("texts"))
    windows = F.sum("windows").over(Window.partitionBy("key"))
    hottest = Window.partitionBy("key").orderBy(F.desc("texts"), "seed")
    weighed = item_seeds.groupBy("key", "seed").agg(F.count("*").alias("windows")).join(
        frequency, "seed"
    ).withColumn("so_far", F.sum("windows").over(hottest))
    sizes = item_seeds.groupBy("key").agg((F.count("*") + width - 1).alias("words"))
    # a word of slack for the rounding of the coverage
    needed = F.ceil((F.col("words") * F.lit(min_coverage) - 1) / width)
    probes = weighed.join(sizes, "key").withColumn("in_texts", windows).where(
        (F.col("in_texts") >= needed) & ((F.col("so_far") >= needed) | (needed <= 1))
    ).select(F.col("key").alias("item_id"), "seed")
    return shared.join(probes, "seed").select("key", "item_id").distinct()


def _joined_hits(
    spark: SparkSession, docs: DataFrame, items: DataFrame, text: str, width: int,
    min_coverage: float, out: str,
) -> DataFrame:
    """The same for a benchmark of any size: seeds are joined, then candidates compared.

    Texts are compared once each, by a 128-bit hash, so copies don't multiply pairs; every
    text meets only the items that its seeds could cover (``_candidate_pairs``).
    """
    key = F.concat_ws(
        "-", F.xxhash64(quoted(text)).cast("string"), F.xxhash64(F.reverse(quoted(text)), F.lit(1)).cast("string")
    )
    texts = stored(
        spark, docs.where(quoted(text).isNotNull()).select(key.alias("key"), quoted(text).alias("text"))
        .groupBy("key").agg(F.first("text").alias("text")), "tiling-texts",
    )
    items = stored(spark, items, "tiling-items")
    pairs = _candidate_pairs(spark, texts, items, width, min_coverage)
    compared = pairs.join(items, "item_id").join(texts, "key")

    def factory():
        def compute(ids: pa.Array, bodies: pa.Array, documents: pa.Array):
            made = []
            for i, body, document in zip(ids.to_pylist(), bodies.to_pylist(), documents.to_pylist()):
                codes, item = codes_of(document), codes_of(body)
                seeded = np.flatnonzero(np.isin(window_hashes(codes, width), window_hashes(item, width)))
                found = hits_of(codes, seeded, [(i, item)], width, min_coverage) if len(seeded) else []
                made.append(found[0] if found else None)
            return [made]
        return compute

    verdicts = add_columns(
        compared, ["item_id", "item_text", "text"],
        T.StructType([T.StructField("hit", HITS.elementType)]), factory,
    ).where("hit IS NOT NULL").groupBy(F.col("key").alias("__key2")).agg(
        F.array_sort(F.collect_list("hit")).alias(out)
    )
    base = without(docs, [out, "__key", "__key2"])
    own = F.coalesce(key, F.lit(""))
    joined = base.withColumn("__key", own).join(verdicts, F.col("__key") == F.col("__key2"), "left")
    return joined.select(
        *[quoted(c) for c in base.columns],
        F.coalesce(quoted(out), F.array().cast(HITS)).alias(out),
    )
