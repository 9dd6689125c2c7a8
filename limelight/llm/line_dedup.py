"""Removal of lines that repeat across documents.

Lines are exploded as hashes of their normal forms, documents are counted per hash, and
the lines of hashes found in too many documents go, except in the first of them. Texts
are put together again from the lines that stay, by position. Only hashes, ids and
positions are exchanged for the counts; texts are exchanged once, to meet the positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .common import LOWER, add_columns, map_batches, quoted, stored, utf8, without


def line_hashes(text: bytes, min_chars: int) -> tuple[list[int], list[bytes]]:
    """Positions and 128-bit hashes of the lines whose key has ``min_chars`` code points.

    The key is the line without ASCII white space at its ends, ASCII letters lowered.
    """
    positions, hashes = [], []
    digest = xxhash.xxh3_128_digest
    for position, line in enumerate(text.translate(LOWER).split(b"\n")):
        key = line.strip()
        # bytes are enough to tell, but for keys near the limit with longer characters
        if len(key) >= min_chars and (
            len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars
        ):
            positions.append(position)
            hashes.append(digest(key))
    return positions, hashes


def exploded(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, hash, position, h1, h2) of every line that can be dropped.

    ``rows`` has id, hash (of the text) and text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, positions, hashes = [], [], []
            for i, text in enumerate(utf8(batch.column(2))):
                p, h = line_hashes(text, min_chars)
                at += [i] * len(p)
                positions += p
                hashes += h
            pairs = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 pa.array(positions, pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                names=["id", "hash", "position", "h1", "h2"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(
        rows.select("id", "hash", "text"), run,
        f"id {kind}, hash bigint, position int, h1 bigint, h2 bigint",
    )


def repeated(lines: DataFrame, documents: int) -> DataFrame:
    """(h1, h2, keeper): hashes found in at least ``documents`` documents, and the first."""
    if documents == 2:  # two documents differ when the smallest and the largest id do
        found = lines.groupBy("h1", "h2").agg(
            F.min("id").alias("keeper"), F.max("id").alias("last")
        ).where("keeper <> last")
    else:
        found = (
            lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.count("id").alias("n"))
            .where(F.col("n") >= documents)
        )
    return found.select("h1", "h2", "keeper")


def drop_repeated_lines(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = 10, documents: int = 2,
) -> DataFrame:
    """``docs`` with the text that stays, n_lines (before) and n_dropped per document.

    Lines whose key has at least ``min_chars`` code points and is found in at least
    ``documents`` documents go, except in the document with the smallest id that holds it;
    there and in documents that hold a line alone, repeats stay. Text is never null
    afterwards: null and empty texts are one empty line. Rows that share an id are one
    document. Rows with a null id count as no document and keep their lines. Other columns
    pass through; one named n_lines or n_dropped is replaced. An empty table gives an
    empty result.
    """
    kept = without(docs, ("n_lines", "n_dropped", "__id", "__hash", "__drop")).withColumns(
        {"__id": quoted(id_col), "__hash": F.xxhash64(quoted(text_col))}
    )
    lines = stored(spark, exploded(kept.where("__id IS NOT NULL").select(
        F.col("__id").alias("id"), F.col("__hash").alias("hash"), quoted(text_col).alias("text"),
    ), min_chars), "lines")
    # stored: both sides of the join are then plain exchanges, which can be split
    known = stored(spark, repeated(lines, documents), "lines-repeated")
    dropped = (
        lines.join(known, ["h1", "h2"]).where("id <> keeper")
        .groupBy("id", "hash").agg(F.collect_set("position").alias("__drop"))
        .select(F.col("id").alias("__id2"), F.col("hash").alias("__hash2"), "__drop")
    )
    joined = kept.join(
        dropped, (F.col("__id") == F.col("__id2")) & (F.col("__hash") == F.col("__hash2")), "left"
    ).drop("__id", "__hash", "__id2", "__hash2")
    outputs = T.StructType([
        T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
    ])

    def factory():
        def compute(texts: pa.Array, drops: pa.Array):
            out, totals, gone = [], [], []
            for text, drop in zip(texts, drops):
                parts = (text.as_py() or "").split("\n")
                totals.append(len(parts))
                if drop.is_valid:
                    places = set(drop.values.to_pylist())
                    parts = [line for i, line in enumerate(parts) if i not in places]
                out.append("\n".join(parts))
                gone.append(totals[-1] - len(parts))
            return [out, totals, gone]
        return compute

    made = add_columns(joined, [text_col, "__drop"], outputs, factory).drop("__drop")
    order = [c for c in kept.columns if c not in ("__id", "__hash")]
    return made.select(*[quoted(c) for c in order], "n_lines", "n_dropped")
