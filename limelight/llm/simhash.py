"""SimHash near-duplicates by a generalised pigeonhole search.

A fingerprint has 64 bits. Bits that vary together are grouped into partitions, each
partition gets a threshold of its own, and two fingerprints that differ in at most
``distance`` bits agree up to the threshold in at least one partition. Every fingerprint
is listed once per partition under its value there and probes all values within the
threshold; candidates are verified on all 64 bits.

Rows of equal fingerprints are one class from the start, so copies are never paired. A
bucket of a few fingerprints is joined in SQL; a bucket of many is cut into blocks, and
each pair of blocks returns a spanning forest of its links instead of the links, which
keeps every component and bounds memory and output. Nothing is capped.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.groups import row_hash
from .common import LOWER, add_columns, quoted, reach_package, small_sample, stored, utf8
from .components import components, forest

BITS = 64


# --- fingerprints ---------------------------------------------------------------------


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """SimHash of one text: majority of the bits of its shingles' hashes, as unsigned.

    Words are what lies between ASCII white space, ASCII upper case is lowered; a text of
    fewer than ``width`` words is one shingle; a text without words gives 0.
    """
    words = text.translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, 1 << 15):  # long texts in slices: 64 bytes per shingle
        part = hashes[start:start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprints(
    df: DataFrame, text: str = "text", out: str = "fingerprint", width: int = 4, seed: int = 42
) -> DataFrame:
    """``df`` with the SimHash of every whole text, the 64 bits as a signed BIGINT.

    Null text counts as empty. A column already named ``out`` is replaced.
    """
    def factory():
        def compute(column: pa.Array):
            prints = np.fromiter(
                (fingerprint(t, width, seed) for t in utf8(column)), np.uint64, len(column)
            )
            return [pa.array(prints.view(np.int64))]
        return compute

    return add_columns(df, [text], T.StructType([T.StructField(out, T.LongType())]), factory)


# --- plan -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bits of each partition and the distance allowed in it; -1 leaves it unsearched."""

    groups: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def bit_matrix(prints: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per fingerprint, bit 0 the lowest."""
    bits = np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits[:, ::-1]


def group_bits(bits: np.ndarray, parts: int) -> tuple[tuple[int, ...], ...]:
    """Split the bit positions into ``parts`` groups of bits that vary together.

    Greedy: a group starts with the free bit most correlated to the others and takes the
    free bits most correlated to its members. Correlated bits in one group leave the
    other groups closer to independent, so their values are more selective.
    """
    centred = bits - bits.mean(axis=0)
    norm = np.sqrt((centred ** 2).sum(axis=0))
    norm[norm == 0] = np.inf  # a constant bit tells nothing
    strength = np.abs(centred.T @ centred) / np.outer(norm, norm)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for p in range(parts):
        size = BITS // parts + (p < BITS % parts)
        order = sorted(free)
        first = order[int(strength[np.ix_(order, order)].sum(axis=1).argmax())]
        group = [first]
        free.discard(first)
        while len(group) < size:
            order = sorted(free)
            gain = strength[np.ix_(order, group)].sum(axis=1)
            pick = order[int(gain.argmax())]
            group.append(pick)
            free.discard(pick)
        groups.append(tuple(sorted(group)))
    return tuple(groups)


def ball(size: int, radius: int) -> int:
    """Number of values within ``radius`` of a value of ``size`` bits."""
    total, term = 0, 1
    for r in range(radius + 1):
        total += term
        term = term * (size - r) // (r + 1)
    return total


def make_plan(
    sample: np.ndarray, population: int, distance: int = 4, parts: tuple[int, ...] = (2, 3, 4, 5, 6),
    probe_cost: float = 20.0,
) -> Plan:
    """Partitions and thresholds with the smallest estimated work.

    For every number of partitions m, thresholds t_i >= -1 with sum ``distance`` - m + 1
    make the search complete. The pairs that a partition yields at threshold t are
    estimated from the distances within a sample and scaled to the ``population``; a
    listed or probed value costs as much as ``probe_cost`` verifications. Dynamic
    programming over partitions and the thresholds' sum finds the cheapest split. The
    sample decides only how much work there is, never what is found.
    """
    sample = np.unique(sample)
    bits = bit_matrix(sample) if len(sample) else np.zeros((1, BITS), np.uint8)
    best, chosen = np.inf, None
    for m in parts:
        # t_i are integers >= -1 of this sum; one more unit than slack must be spent
        budget = distance - m + 1 + m  # sum of (t_i + 1)
        if budget < 1:
            continue
        groups = group_bits(bits.astype(np.float64), m)
        cost = np.zeros((m, budget + 1))
        for i, group in enumerate(groups):
            own = bits[:, group].astype(np.float32)
            near = own @ own.T + (1 - own) @ (1 - own).T
            apart = len(group) - np.rint(near).astype(int)
            counts = np.bincount(apart[np.triu_indices(len(own), 1)], minlength=BITS + 1)
            pairs = max(1, counts.sum())
            for t in range(budget):
                if t > len(group):
                    cost[i, t + 1] = np.inf
                    continue
                share = (counts[:t + 1].sum() + 0.5) / pairs
                # never below what evenly spread values would give
                share = max(share, ball(len(group), t) / 2.0 ** len(group))
                cost[i, t + 1] = (
                    share * population * population / 2
                    + probe_cost * population * (1 + ball(len(group), t))
                )
        # table[s]: cheapest thresholds of the partitions so far with sum(t + 1) = s
        table = {0: (0.0, ())}
        for i in range(m):
            grown: dict[int, tuple[float, tuple[int, ...]]] = {}
            for spent, (total, picks) in table.items():
                for t in range(-1, budget - spent):
                    entry = (total + cost[i, t + 1], picks + (t,))
                    if entry < grown.get(spent + t + 1, (np.inf, ())):
                        grown[spent + t + 1] = entry
            table = grown
        total, picks = table[budget]
        if total < best:
            best, chosen = total, Plan(groups, picks)
    return chosen


# --- search ---------------------------------------------------------------------------


def _value(group: tuple[int, ...], column="fp"):
    """Bits of a group as a mask of the fingerprint: equal masks mean equal values."""
    return F.col(column).bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _flips(group: tuple[int, ...], radius: int) -> list[int]:
    return [
        _signed(sum(1 << b for b in bits))
        for r in range(radius + 1) for bits in combinations(group, r)
    ]


def listed(prints: DataFrame, plan: Plan) -> DataFrame:
    """(part, value, fp): where each fingerprint is found."""
    parts = [
        F.struct(F.lit(i).alias("part"), _value(g).alias("value"))
        for i, (g, t) in enumerate(zip(plan.groups, plan.thresholds)) if t >= 0
    ]
    return prints.select("fp", F.explode(F.array(*parts)).alias("at")).select("at.*", "fp")


def probed(prints: DataFrame, plan: Plan) -> DataFrame:
    """(part, value, fp): every place where each fingerprint looks."""
    def places(i: int, group: tuple[int, ...], radius: int):
        flips = F.array(*[F.lit(x).cast("bigint") for x in _flips(group, radius)])
        return F.transform(flips, lambda x: F.struct(
            F.lit(i).alias("part"), _value(group).bitwiseXOR(x).alias("value")
        ))

    parts = [
        places(i, g, t)
        for i, (g, t) in enumerate(zip(plan.groups, plan.thresholds)) if t >= 0
    ]
    return prints.select("fp", F.explode(F.concat(*parts)).alias("at")).select("at.*", "fp")


def nearby(values: DataFrame, plan: Plan) -> DataFrame:
    """``values`` (part, value) with every value (near) whose fingerprints look there."""
    flips = F.array(*[
        F.array(*[F.lit(x) for x in _flips(g, t)]).cast("array<bigint>")
        for g, t in zip(plan.groups, plan.thresholds)
    ])
    return values.withColumn("near", F.explode(flips[F.col("part")])).withColumn(
        "near", F.col("value").bitwiseXOR(F.col("near"))
    )


def block_links(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    """A spanning forest of the links between two blocks, as rows of two fingerprints."""
    found = []
    for start in range(0, len(left), 256):
        part = left[start:start + 256]
        # unsigned: of signed numbers numpy counts the bits of the magnitude
        apart = np.bitwise_count(part.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :])
        close = apart <= distance
        i, j = np.nonzero(close & (part[:, None] != right[None, :]))
        if len(i):
            found.append(forest(part[i], right[j]))
    if not found:
        return np.empty((0, 2), np.int64)
    every = np.concatenate(found)
    return forest(every[:, 0], every[:, 1])


def _block_pairs(distance: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        looks = pdf["side"].to_numpy()
        fp = pdf["fp"].to_numpy()
        links = block_links(np.unique(fp[looks == 0]), np.unique(fp[looks == 1]), distance)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})
    return run


def links(
    spark: SparkSession, prints: DataFrame, plan: Plan, distance: int = 4,
    bucket: int = 48, block: int = 4096,
) -> DataFrame:
    """(a, b): links between distinct fingerprints that give the components of all links.

    ``prints`` has one row per fingerprint (column fp). Buckets of at most ``bucket``
    fingerprints return all their links; the others return a spanning forest per pair of
    blocks of at most about ``block`` fingerprints: those listed in the bucket are cut into
    blocks, and so are those that probe it.
    """
    index, probes = listed(prints, plan), probed(prints, plan)
    sizes = stored(spark, index.groupBy("part", "value").count(), "simhash-sizes")
    large_ones = sizes.where(F.col("count") > bucket).select("part", "value", "count")
    looks = nearby(large_ones, plan).join(
        sizes.select("part", F.col("value").alias("near"), F.col("count").alias("probes")),
        ["part", "near"],
    ).groupBy("part", "value", "count").agg(F.sum("probes").alias("probes"))
    hot = stored(spark, looks.select(
        "part", "value", *[
            F.ceil(F.col(c) / F.lit(block)).cast("int").alias(name)
            for c, name in (("count", "index_blocks"), ("probes", "probe_blocks"))
        ],
    ), "simhash-hot")
    small_index = index.join(hot, ["part", "value"], "left_anti")
    small = (
        probes.alias("p").join(small_index.alias("i"), ["part", "value"])
        .where("p.fp < i.fp").where(F.bit_count(F.col("p.fp").bitwiseXOR(F.col("i.fp"))) <= distance)
        .select(F.col("p.fp").alias("a"), F.col("i.fp").alias("b"))
    )

    def dealt(rows: DataFrame, side: int) -> DataFrame:
        """Each row once per block of the other side."""
        mine, others = ("probe_blocks", "index_blocks")[::-1 if side else 1]
        own = F.pmod(F.xxhash64("fp"), F.col(mine)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        rows = rows.join(hot, ["part", "value"]).withColumn("own", own).withColumn("other", other)
        first, second = ("own", "other") if side == 0 else ("other", "own")
        return rows.select(
            "part", "value", F.col(first).alias("left"), F.col(second).alias("right"),
            F.lit(side).alias("side"), "fp",
        )

    reach_package(prints)
    large = (
        dealt(probes, 0).unionByName(dealt(index, 1))
        .groupBy("part", "value", "left", "right")
        .applyInPandas(_block_pairs(distance), "a bigint, b bigint")
    )
    return small.unionByName(large)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = 4, distance: int = 4, sample: int = 2048, bucket: int = 48, block: int = 4096,
) -> DataFrame:
    """One row per input row: id, fingerprint (BIGINT) and component_id.

    ``component_id`` is the smallest id among the rows that are reachable over links of at
    most ``distance`` differing bits. Texts that are null or without words have
    fingerprint 0 and are linked like any other. A null id keeps its row and is never a
    component id, unless the component has no other. Repeated rows are kept and share
    their component. An empty table gives an empty result. Other columns are not read.

    ``sample`` bounds the fingerprints the search plan is estimated from.
    """
    found = grouped(spark, docs, id_col, text_col, width, distance, sample, bucket, block)
    return found.select("id", F.col("fp").alias("fingerprint"), "component_id")


def grouped(
    spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, width: int, distance: int,
    sample: int, bucket: int, block: int,
) -> DataFrame:
    """(id, text_hash, fp, root, component_id) of every row.

    ``root`` is the smallest fingerprint of the component: unlike ``component_id`` it differs
    between components whose smallest ids are equal.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    marked = stored(
        spark, with_fingerprints(rows, "text", "fp", width).select(
            "id", F.xxhash64("text").alias("text_hash"), "fp"
        ), "simhash-rows",
    )
    classes = stored(
        spark, marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes"
    )
    population = classes.count()
    picked = small_sample(classes.select("fp"), "fp", sample).toPandas()["fp"]
    plan = make_plan(picked.to_numpy(np.int64).view(np.uint64), population, distance)
    found = links(spark, classes.select("fp"), plan, distance, bucket, block)
    labels = components(spark, found)  # node, root: fingerprints that have links
    linked = stored(
        spark, labels.join(classes, labels["node"] == classes["fp"]).select("fp", "first", "root"),
        "simhash-linked",
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    renamed = linked.join(smallest, "root").select("fp", "root", "smallest")
    named = stored(
        spark,
        classes.join(renamed, "fp", "left")
        .select(
            "fp", F.coalesce("root", "fp").alias("root"),
            F.coalesce("smallest", "first").alias("component_id"),
        ),
        "simhash-named",
    )
    return marked.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def hex_of(column) -> "F.Column":
    """A 64-bit value as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_first(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = 4, distance: int = 4, sample: int = 2048, bucket: int = 48, block: int = 4096,
) -> DataFrame:
    """``docs`` with one row per component: the one with the smallest id.

    Of rows that repeat that id within the component, the one whose text has the smallest
    hash stays, and of equal texts the row with the smallest hash; an id whose texts are in
    several components stays once in each. Rows with a null id stay only when their
    component has no id at all, one of them then.
    """
    found = grouped(spark, docs, id_col, text_col, width, distance, sample, bucket, block)
    firsts = found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("id").alias("__first"), F.min("text_hash").alias("__first_text")
    )
    rows = docs.withColumn("__text_hash", F.xxhash64(quoted(text_col)))
    same = F.col("__text_hash") == F.col("__first_text")
    named = rows.join(
        firsts.where("__first IS NOT NULL"), (quoted(id_col) == F.col("__first")) & same, "left_semi"
    )
    nameless = rows.where(quoted(id_col).isNull()).join(
        firsts.where("__first IS NULL"), same, "left_semi"
    )

    def one_each(kept: DataFrame) -> DataFrame:
        whole = F.struct(*[quoted(c) for c in docs.columns])
        return kept.groupBy(quoted(id_col).alias("__id"), "__text_hash").agg(
            F.min_by(whole, row_hash(docs)).alias("__row")
        ).select("__row.*")

    return one_each(named).unionByName(one_each(nameless))
