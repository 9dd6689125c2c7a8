"""The operators applied to the given tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    collocations, compression, licenses, line_dedup, mixing, packing, prefix_trie, quality_lines,
    sharding, simhash, tiling, token_counts, urls,
)
from .common import crc32_of_id

Query = Callable[[SparkSession, str], DataFrame]

#: Host and path rules of the URL filter (fixed values).
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)
#: Words in a host name that put a page's URL on the list of unwanted ones.
LISTED_HOSTS = ("adult", "bets", "casino", "pills", "spam", "ads-track")
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_lines.train(docs, quality_labels(spark, sf_dir))
    return quality_lines.judge(docs, field).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_content_lines",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
        F.size("detections").cast("bigint").alias("n_detections"),
    )


def listed_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages whose host holds a listed word."""
    host = urls.host_of(F.col("url"))
    unwanted = F.lit(False)
    for word in LISTED_HOSTS:
        unwanted |= host.contains(word)
    return pages.where(unwanted).select("url")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(spark, pages, listed_urls(pages), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "listed"
    )


def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(4)) == 2
    model = compression.train(docs, quality_labels(spark, sf_dir).where(~held_out))
    return compression.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(spark, docs, width=4, distance=4).select(
        F.col("id").alias("doc_id"), simhash.hex_of(F.col("fingerprint")).alias("fingerprint"),
        "component_id",
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_length", "step_group",
    )


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    )
    return sharding.shard(spark, docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(spark, docs, min_chars=10, documents=2).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of every document that holds a benchmark item, with the evidence."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tiling.with_hits(spark, docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select(
        "doc_id", "h.item_id", F.col("h.matched").cast("bigint").alias("matched"),
        F.col("h.item_words").cast("bigint").alias("item_words"), "h.coverage",
        F.size("h.tiles").cast("bigint").alias("n_tiles"), F.lit(True).alias("contaminated"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    ).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(spark, table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    phrases = collocations.collocations(spark, docs, min_count=100, longest=5, covered=100)
    return collocations.top_collocations(phrases, top=2000).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op13_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pieces = mixing.schedule(spark, docs, weights=(5, 2, 1), share=1.5, repeats=2)
    return mixing.per_document(pieces).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_position"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    every = (
        op1_quality_lines, op2_license_scan, op3_url_filter, op4_compression_quality, op5_simhash,
        op6_packing, op7_histogram_shards, op8_line_dedup, op9_string_tiling, op10_token_counts,
        op11_prefix_trie, op12_collocations, op13_weighted_fair_mix, pipeline,
    )
    return {q.__name__: q for q in every}


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE_SQL

    return ORACLE_SQL
