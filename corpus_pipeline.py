"""From raw documents to packed training sequences.

Each stage takes the documents that the one before kept, written as Parquet and read
again, and returns those it keeps with the same columns; the last returns packed pieces.
Extra columns are carried through all stages but the last, whatever their names. An empty
table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from limelight.llm import line_dedup, packing, quality_lines, simhash, tiling
from limelight.llm.queries import quality_labels, table
from limelight.session import remove_path, scratch_dir

#: None: hashing, tiling and tokenising have no SQL form.
ORACLE_SQL = None


def beside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` over ``docs``, whose other columns it gets by names that no operator uses."""
    own = ("doc_id", "text", "n_chars")
    names = [c if c in own else f"__column_{i}" for i, c in enumerate(docs.columns)]
    return stage(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines.

    Null and empty texts have no words and go. Rows that repeat a text share its fate; a null
    doc_id is carried. Without labels of both kinds the base rules alone decide.
    """
    field = quality_lines.train(docs, quality_labels(spark, sf_dir))
    return beside(docs, lambda rows: quality_lines.judge(rows, field).where("kept"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; n_chars follows the text.

    A null or empty text is one empty line and becomes an empty text; no document goes. The
    smallest doc_id that holds a line keeps it, so rows that repeat one keep it in all rows.
    """
    return beside(docs, lambda rows: line_dedup.drop_repeated_lines(spark, rows).withColumn(
        "n_chars", F.length("text").cast("bigint")
    ))


def simhash_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies.

    First is the smallest doc_id. Texts without words are copies of each other, so one null
    or empty text at most stays; of rows that repeat a doc_id within a group one stays.
    """
    return beside(docs, lambda rows: simhash.keep_first(spark, rows, width=4, distance=4))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay. Items without a text or of fewer than five words
    are never held. Rows that repeat a text share its fate.
    """
    items = table(spark, sf_dir, "benchmark")
    return beside(docs, lambda rows: tiling.with_hits(spark, rows, items).where(F.size("hits") == 0))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of several lengths.

    A null or empty text is its end id alone; rows that repeat are packed as often as they
    occur, and null ids are carried. Which window a piece gets follows the input's tasks.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("simhash_dedup", simhash_deduplication),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; every result but the last is written and reread.

    What a stage read is removed once its own result is written, so one copy of the corpus
    is stored at a time. Nulls, ties and empty tables: see the stages.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if read is not None:
            remove_path(spark, read)
        read = path
    return STAGES[-1][1](spark, docs, sf_dir)
