"""URL filter: host and path rules, and a list of URLs behind a blocked Bloom filter.

DataFrame functions only. The filter is a table of blocks of eight 32-bit words; a
canonical URL's hash picks one block and one bit in each word. Pages whose bits are all set
are possible hits and go on to an exact hash join with the list, which removes the false
positives; the others, nearly all, never meet the list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import quoted, stored, without

WORDS, WORD_BITS = 8, 32


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(column: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(
        column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, lowered; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.`` and a port, path without final slashes or ``.html``.

    Scheme, query and fragment play no part. Null where there is no host.
    """
    plain = F.regexp_replace(F.regexp_replace(host, r":\d*$", ""), r"^(www|m)\.", "")
    short = F.regexp_replace(F.regexp_replace(path, r"\.html?$", ""), r"/+$", "")
    return F.when(host != "", F.concat(plain, short))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Place of the longest rule that fits, or null."""
    out = F.lit(None).cast("int")
    for i, rule in sorted(enumerate(rules), key=lambda x: len(x[1].name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path)
        )
        out = F.when(fits, F.lit(i)).otherwise(out)  # longer ones are asked first
    return out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    """One bit in each word of a block: five bits each of a second hash."""
    key = F.xxhash64(url, F.lit("bits"))
    return [
        F.shiftright(key, 5 * k).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for k in range(WORDS)
    ]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 ... w7): the filter of the column url of ``keys``."""
    one = F.lit(1).cast("bigint")
    words = [
        F.bit_or(F.call_function("shiftleft", one, bit)).alias(f"w{k}")
        for k, bit in enumerate(_bits(F.col("url")))
    ]
    return keys.groupBy(_block(F.col("url"), blocks).alias("block")).agg(*words)


def possible(rows: DataFrame, filter_: DataFrame, blocks: int, broadcast: bool) -> DataFrame:
    """``rows`` (with __url, not null) whose bits are all set in the filter."""
    one = F.lit(1).cast("bigint")
    hits = None
    for k, bit in enumerate(_bits(F.col("__url"))):
        set_ = F.col(f"w{k}").bitwiseAND(F.call_function("shiftleft", one, bit)) != 0
        hits = set_ if hits is None else hits & set_
    side = F.broadcast(filter_) if broadcast else filter_
    return rows.join(side, (_block(F.col("__url"), blocks) == F.col("block")) & hits, "left_semi")


def listed_keys(listed: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct canonical URLs (column url) of a table of URLs; those without host go."""
    url = quoted(url_col)
    return listed.select(canonical(host_of(url), path_of(url)).alias("url")).where(
        "url IS NOT NULL"
    ).distinct()


def filter_urls(
    spark: SparkSession, pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...],
    url_col: str = "url", default: str = "allow", listed_verdict: str = "block",
    bits_per_key: int = 16, broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """``pages`` with host, path, rule (its name, else null), listed and verdict.

    The longest fitting rule decides; a page without one is judged by the list: a listed
    canonical URL gives ``listed_verdict``, any other ``default``. Null URLs and those
    without ``://`` have an empty host and path and meet neither. Repeated rows stay.
    Empty tables: an empty list blocks nothing, no pages give no rows. Columns named like
    an output are replaced, others pass through.

    The filter has ``bits_per_key`` bits per listed URL and is broadcast only if it has at
    most ``broadcast_bytes``; a larger one is joined by block. Only distinct canonical URLs
    are probed, so a URL of a third of all rows is one row there.
    """
    plain = without(pages, ("host", "path", "rule", "listed", "verdict", "__url", "__rule"))
    split = plain.withColumns({"host": host_of(quoted(url_col)), "path": path_of(quoted(url_col))})
    marked = split.withColumns({
        "__rule": rule_of(F.col("host"), F.col("path"), rules),
        "__url": canonical(F.col("host"), F.col("path")),
    })
    keys = stored(spark, listed_keys(listed, url_col), "urls-listed")
    count = keys.count()
    blocks = max(1, -(-count * bits_per_key // (WORDS * WORD_BITS)))
    filter_ = bloom(keys, blocks)
    small = blocks * (WORDS + 1) * 8 <= broadcast_bytes
    asked = marked.where("__url IS NOT NULL").select("__url").distinct()
    maybe = possible(asked, filter_, blocks, small)
    hits = stored(spark, maybe.join(keys, F.col("__url") == keys["url"], "left_semi").select(
        F.col("__url").alias("__hit")
    ), "urls-hits")
    # pages without a host never match; a key of their own keeps them from one partition
    own = F.coalesce(F.col("__url"), F.concat(F.lit("\x00"), F.xxhash64(*[
        quoted(c) for c in plain.columns
    ]).cast("string")))
    joined = marked.withColumn("__own", own).join(hits, F.col("__own") == F.col("__hit"), "left")
    listed_ = F.col("__hit").isNotNull()
    by_rule = F.lit(None).cast("string")
    name = F.lit(None).cast("string")
    for i, rule in enumerate(rules):
        by_rule = F.when(F.col("__rule") == i, F.lit(rule.verdict)).otherwise(by_rule)
        name = F.when(F.col("__rule") == i, F.lit(rule.name)).otherwise(name)
    return joined.select(
        *[quoted(c) for c in plain.columns], "host", "path", name.alias("rule"),
        listed_.alias("listed"),
        F.coalesce(by_rule, F.when(listed_, F.lit(listed_verdict)).otherwise(F.lit(default))).alias("verdict"),
    )
