"""Shards of nearly equal bytes by a histogram sort. DataFrame functions only.

Rows are ordered by a key of two 64-bit numbers: a hash of the text, so that equal texts
lie together, and a hash of the id, which orders within a text. The boundaries between shards are
found without sorting: evenly spaced probe keys are laid into the cell of every boundary
that is still open, one aggregation counts the exact bytes and rows between them, and the
cell shrinks to the two probes around the boundary's target, until a probe meets the
tolerance or no key is left between. Then the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import quoted, stored, without

LOW, HIGH = -(1 << 63), 1 << 63


@dataclass
class Boundary:
    """A boundary's target in bytes and the cell of keys that it lies in."""

    target: int
    cell: int = 0  # the keys' leading bits; of ids once a single hash is left
    hash: int | None = None  # that hash
    bytes_below: int = 0  # before the cell
    rows_below: int = 0
    found: tuple[int, int] | None = None  # first key behind the boundary

    def settle(self, key: int, bytes_below: int, rows_below: int) -> None:
        if self.hash is not None:
            self.found = (self.hash, key) if key < HIGH else (self.hash + 1, LOW)
        else:
            self.found = (key, LOW)
        self.bytes_below, self.rows_below = bytes_below, rows_below

    def refine(self, cells: list[tuple[int, int, int]], shift: int, allowed: int) -> None:
        """Move into one of the cells (number, bytes, rows) that the current one was cut into.

        The boundary is settled at an end of the cell that is near enough to the target, or
        at the nearer end where a single row, or a single key, is left.
        """
        below, rows, size, n = self.bytes_below, self.rows_below, 0, 0
        for cell, size, n in cells:
            if below + size > self.target:
                break
            below, rows = below + size, rows + n
        else:  # no row lies behind the target
            self.found = (HIGH, LOW)
            return
        before, behind = self.target - below, below + size - self.target
        last = n == 1 or shift == 0 and self.hash is not None
        if before <= behind and (before <= allowed or last):
            self.settle(cell << shift, below, rows)
        elif behind <= allowed or last:
            self.settle((cell + 1) << shift, below + size, rows + n)
        else:
            self.bytes_below, self.rows_below = below, rows
            if shift:
                self.cell = cell
            else:  # one hash is left: go on with its ids
                self.hash, self.cell = cell, 0


def keyed(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """``df`` with the sort key and the size of each row: __hash, __id, __size."""
    chars = quoted(text)
    return df.select(
        "*", F.xxhash64(chars).alias("__hash"),
        F.when(quoted(id_col).isNull(), F.lit(LOW)).otherwise(F.xxhash64(quoted(id_col))).alias("__id"),
        (F.coalesce(F.octet_length(chars), F.lit(0)).cast("bigint") + 8).alias("__size"),
    )


def _descend(keys: DataFrame, column: str, open_: list[Boundary], allowed: int, probes: int) -> None:
    """Refine boundaries by ever more leading bits of ``column``, one aggregation each.

    The rows of all open cells are counted between evenly spaced probes, about ``probes`` in
    all: as many rows come to the driver, whatever the data's size.
    """
    by_id, shift = column == "__id", 64
    while shift and (open_ := [b for b in open_ if b.found is None]):
        places = {(b.hash, b.cell) for b in open_}
        bits = min(shift, max(1, (probes // len(places)).bit_length() - 1))
        rows = keys
        if by_id:
            rows = rows.where(F.col("__hash").isin(sorted({h for h, _ in places})))
        if shift < 64:
            rows = rows.where(F.shiftright(column, shift).isin(sorted({c for _, c in places})))
        shift -= bits
        cell = F.shiftright(column, shift) if shift else F.col(column)
        owner = F.col("__hash") if by_id else F.lit(None).cast("bigint")
        counted = rows.groupBy(owner.alias("hash"), cell.alias("cell")).agg(
            F.sum("__size").alias("bytes"), F.count("*").alias("rows")
        )
        cells: dict[tuple[int | None, int], list[tuple[int, int, int]]] = {}
        for r in counted.collect():
            parent = r["cell"] >> bits if shift + bits < 64 else 0
            cells.setdefault((r["hash"], parent), []).append((r["cell"], r["bytes"], r["rows"]))
        for group in cells.values():
            group.sort()
        for b in open_:
            b.refine(cells.get((b.hash, b.cell), []), shift, allowed)


def boundaries(
    keys: DataFrame, parts: int, total: int, tolerance: float = 0.002, probes: int = 1 << 16
) -> list[Boundary]:
    """``parts`` - 1 boundaries that cut the keys into parts of nearly equal bytes.

    A boundary is settled when the bytes below a probe are within ``tolerance`` of a
    part's share of the target, or at the nearest row. Hashed keys take two or three
    passes; texts that fill more than a part are then searched by id.
    """
    allowed = int(tolerance * total / parts)
    every = [Boundary(total * (i + 1) // parts) for i in range(parts - 1)]
    _descend(keys, "__hash", every, allowed, probes)
    _descend(keys, "__id", every, allowed, probes)
    return every


def _search(cuts: list[tuple[int, int]]):
    """Number of cuts at or below a row's key: a binary search over a literal array."""
    if not cuts:
        return F.lit(0)
    array = F.array(*[
        F.struct(F.lit(h).cast("bigint").alias("h"), F.lit(i).cast("bigint").alias("i"))
        for h, i in cuts
    ])
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    key = F.struct(F.col("__hash").alias("h"), F.col("__id").alias("i"))

    def advance(at, step):
        ahead = at + step
        fits = (ahead <= len(cuts)) & (F.get(array, ahead - 1) <= key)
        return F.when(fits, ahead).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def _cells(keyed_: DataFrame, bits: int, place: Column) -> DataFrame:
    """Keys with their shard and the cell of their hash: its first ``bits`` bits.

    The generator computes both once, and keeps the search out of join conditions.
    """
    cell = F.shiftright("__hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    return keyed_.select("*", F.inline(F.array(F.struct(
        place.cast("int").alias("__shard"), cell.alias("__cell")
    ))))


def _part() -> Column:
    """The part of a cell: the first ``__bits`` bits of the id's hash."""
    bits = F.coalesce("__bits", F.lit(0))
    return F.when(bits > 0, F.call_function("shiftright", F.col("__id"), 64 - bits)).otherwise(
        F.lit(0).cast("bigint")
    )


def shard(
    spark: SparkSession, docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
    text_col: str = "text", piece_rows: int = 20_000, tolerance: float = 0.002,
    probes: int = 1 << 16,
) -> DataFrame:
    """``docs`` with size, shard (0 to ``shards`` - 1) and slot (gapless from 0 per shard).

    Law: the shards' bytes are nearly equal, each boundary within ``tolerance`` of a
    shard's share or at the nearest row. size is the UTF-8 bytes of the text plus 8 (null
    text: 8). Shards hold ranges of (hash of the text, hash of the id): equal texts lie
    together and share a shard unless a boundary falls between them. Ids are of any type.
    Rows that repeat a text and an id stay together; they are alike, and so is the order of
    their slots. A null id sorts first. Empty table: empty result. Columns named like an
    output are replaced, others (nulls too) pass through, and only those that are read later
    are exchanged.

    Rows are exchanged once, in pieces of about ``piece_rows`` rows: cells of a shard's
    hashes, and parts of a cell that one text fills, by the hashes of its ids. A table of
    the pieces, counted on the keys alone, tells the rows of the shard before each, so no
    task numbers a whole shard and nothing but the shards' boundaries comes to the driver.
    """
    named = without(docs, ("size", "shard", "slot"))
    # by place, so that no column clashes with those used in between
    place_of = {c.lower(): f"c{i}" for i, c in enumerate(named.columns)}
    plain = named.toDF(*[f"c{i}" for i in range(len(named.columns))])
    rows = keyed(plain, place_of[text_col.lower()], place_of[id_col.lower()])
    keys = stored(spark, rows.select("__hash", "__id", "__size"), "shard-keys")
    counted = keys.agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows")).first()
    found = boundaries(keys, shards, counted["bytes"] or 0, tolerance, probes)
    place = _search([b.found for b in found if b.found[0] < HIGH])  # those behind all keys come last
    bits = min(48, (counted["rows"] // piece_rows).bit_length())
    placed = _cells(keys, bits, place)
    # cells that hold more than a few pieces' rows: a text with very many rows
    cell_rows = placed.groupBy("__cell").agg(F.count("*").alias("__n")).where(F.col("__n") > 4 * piece_rows)
    crowded = stored(spark, cell_rows.select(
        F.col("__cell").alias("__crowded"),
        (F.length(F.bin(F.floor(F.col("__n") / piece_rows)))).cast("int").alias("__bits"),
    ), "shard-crowded")
    if crowded.isEmpty():
        parted = lambda df: df.withColumn("__part", F.lit(0).cast("bigint"))
    else:
        def parted(df: DataFrame) -> DataFrame:
            return df.join(crowded, F.col("__cell") == F.col("__crowded"), "left").withColumn(
                "__part", _part()
            ).drop("__crowded", "__bits")
    piece = ["__shard", "__cell", "__part"]
    sizes = parted(placed).groupBy(*piece).agg(F.count("*").alias("__rows"))
    in_shard = Window.partitionBy("__shard").orderBy("__cell", "__part")
    pieces = stored(spark, sizes.select(
        *piece, (F.sum("__rows").over(in_shard) - F.col("__rows")).alias("__before")
    ), "shard-pieces")
    exchanged = parted(_cells(rows, bits, place)).join(pieces, piece)
    order = Window.partitionBy(*piece).orderBy("__hash", "__id")
    return exchanged.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(named.columns)], F.col("__size").alias("size"),
        F.col("__shard").alias("shard"),
        (F.row_number().over(order) - 1 + F.col("__before")).cast("bigint").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its files in slot order."""
    sharded.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(path)
