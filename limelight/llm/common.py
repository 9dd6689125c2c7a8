"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_dir

#: Folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])
#: ASCII upper case to lower case, every other byte unchanged.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Splits like ``str.split("\n")`` and yields words of ``[^\x20\x09-\x0D]+`` when applied
#: to UTF-8: ``bytes.split()`` and ``bytes.strip()`` know exactly those six separators.


def quoted(name: str):
    """Column of exactly this name, also when it holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns of these names, compared as Spark compares them."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, with this package on the Python path of the workers.

    Workers get the driver's place of the package besides their own path, which a local
    session needs; a cluster has it installed or shipped with ``--py-files``.
    """
    reach_package(df)
    # by place: mapInArrow itself can't look up names with dots
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


def reach_package(df: DataFrame) -> None:
    environment = df.sparkSession.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, ROOT]))


def add_columns(
    df: DataFrame,
    inputs: list[str],
    outputs: T.StructType,
    factory: Callable[[], Callable[..., list[pa.Array | list]]],
) -> DataFrame:
    """Rows of ``df`` with new columns computed per Arrow batch in Python.

    ``factory`` runs once per task and returns a function from the Arrow columns ``inputs``
    to one sequence per output field. Input columns named like an output are replaced.
    No shuffle; one batch is in memory at a time.
    """
    kept = without(df, outputs.names)
    carried = [f.name for f in kept.schema.fields]
    # inputs that the outputs replace still have to be read
    hidden = [c for c in inputs if c not in carried]
    source = df.select(
        *[quoted(c) for c in carried],
        *[quoted(c).alias(f"__in_{i}") for i, c in enumerate(hidden)],
    )
    place = {c: i for i, c in enumerate(carried)}
    place.update({c: len(carried) + i for i, c in enumerate(hidden)})
    positions = [place[c] for c in inputs]
    n_carried = len(carried)
    schema = T.StructType(kept.schema.fields + outputs.fields)
    names = schema.names
    kinds = [to_arrow_type(f.dataType) for f in outputs.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = factory()
        for batch in batches:
            made = compute(*[batch.column(p) for p in positions])
            arrays = [
                a.cast(k) if isinstance(a, pa.Array) else pa.array(a, k)
                for a, k in zip(made, kinds)
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:n_carried] + arrays, names)

    return map_batches(source, run, schema)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8; null reads as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again.

    Cuts the lineage in a place that survives the loss of an executor, gives the planner
    real sizes, and saves later branches from computing ``df`` anew.
    """
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """``size`` rows with the smallest hash of ``key``: the same rows in every run."""
    order = F.xxhash64(quoted(key), F.lit("sample"))
    return df.orderBy(order, quoted(key)).limit(size)


def labelled_ids(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label",
    id_col: str = "doc_id",
) -> DataFrame:
    """(id, label) of every labelled document with a text, one row per id.

    Labels other than 0 and 1 don't count; of an id labelled twice the smaller one does.
    """
    known = labels.where(quoted(label).isin(0, 1) & quoted(id_col).isNotNull()).groupBy(
        quoted(id_col).alias("id")
    ).agg(F.min(quoted(label)).cast("int").alias("label"))
    present = docs.where(quoted(text).isNotNull()).select(quoted(id_col).alias("id")).distinct()
    return known.join(present, "id")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, size: int, each: bool = False, text: str = "text",
    label: str = "label", id_col: str = "doc_id",
) -> DataFrame:
    """(id, text, label) of at most ``size`` labelled documents (``each``: of either label).

    Those with the smallest hashes of their ids, so the same ones in every run. Only ids
    meet the labels; the chosen ones, bounded by ``size``, are broadcast to find the texts.
    Of an id's texts the one with the smallest hash counts, so ``size`` bounds the rows too.
    """
    found = labelled_ids(docs, labels, text, label, id_col)
    if each:
        chosen = small_sample(found.where("label = 0"), "id", size).unionByName(
            small_sample(found.where("label = 1"), "id", size)
        )
    else:
        chosen = small_sample(found, "id", size)
    texts = docs.where(quoted(text).isNotNull()).select(
        quoted(id_col).alias("id"), quoted(text).alias("text")
    )
    # one row per id, whatever the number of rows that repeat it
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    ).select("id", "first.text", "label")


def crc32_of_id(column) -> "F.Column":
    """crc32 of an integer id written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def words_pattern() -> re.Pattern:
    """Lower-case letters and digits of any script; used by benchmark matching."""
    return re.compile(r"[^\W_]+")
