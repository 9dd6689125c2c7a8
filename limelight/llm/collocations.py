"""Phrase collocations per language by SON partitioning.

Texts are dealt by hash into a few shards, each spread over many tasks. A phrase found
``min_count`` times in all is found, in some shard, at least the shard's share of that often.
Every shard is mined completely at its share of the support, lowered once more so that most
counts get known: tasks count the phrases of their texts, and what they counted is added up
by shard and phrase. What is frequent in a shard is a candidate, unless its known counts and
the highest possible unknown ones stay below the support. Longer phrases are only looked for
where all pairs of neighbours in them are candidates. A last pass over all texts counts the
candidates exactly.

The number of shards, and so the local support, does not depend on the corpus, and what is
shuffled grows in proportion to it. While mining, phrases are 64-bit hashes in numpy arrays;
two that share a hash could only make one more candidate. The last pass counts words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.groups import first_n_per_group, lookup_join
from .common import map_batches, quoted, reach_package, stored, utf8

#: Ends a piece; no word holds it.
STOP = b"."
#: Lower-cases A-Z, makes every mark between pieces a stop and every blank a space.
CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else STOP[0] if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
    for c in range(256)
)


class Words(dict):
    """Numbers words from 1 in the order they come; 0 stands between pieces."""

    def __init__(self) -> None:
        super().__init__({STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Corpus:
    """Word numbers of a task's texts in one language, by shard."""

    def __init__(self) -> None:
        self.words = Words()
        self.parts: dict[int, list[np.ndarray]] = {}

    def add(self, shard: int, text: bytes) -> int:
        tokens = text.translate(CLEAN).replace(STOP, b" . ").split()
        tokens.append(STOP)
        numbers = np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))
        self.parts.setdefault(shard, []).append(numbers)
        return len(tokens)

    def numbers(self) -> Iterator[tuple[int, np.ndarray]]:
        for shard, parts in self.parts.items():
            yield shard, np.concatenate(parts)

    def hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)


def extended(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases made one word longer."""
    x = keys * np.uint64(0x9E3779B97F4A7C15) + words
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def phrases_of(a: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple]:
    """(words, hashes, whether it lies within a piece) of what begins at each place."""
    single = hashes[a]
    keys, whole = single, a > 0
    yield 1, keys, whole
    for k in range(2, longest + 1):
        keys = extended(keys[:-1], single[k - 1:])
        whole = whole[:-1] & (a[k - 1:] > 0)
        yield k, keys, whole


def member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def merged_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _corpora(batches: Iterator[pa.RecordBatch], task_words: int) -> Iterator[dict[str, Corpus]]:
    """Texts (lang, shard, text) by language, about ``task_words`` words at a time."""
    held: dict[str, Corpus] = {}
    size = 0
    for batch in batches:
        langs, shards = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, shard, text in zip(langs, shards, utf8(batch.column(2))):
            size += held.setdefault(lang, Corpus()).add(shard, text)
            if size >= task_words:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _mined(
    texts: DataFrame, supports: DataFrame, lengths: range, task_words: int, bits: int,
    pairs: tuple[dict[str, np.ndarray], int, int] | None = None,
) -> DataFrame:
    """(lang, shard, key, count, slack) of the phrases of these lengths frequent in a shard.

    Counts of a task go, sorted by hash, in ``2 ** bits`` ranges of hashes to those that add
    them up, so a range has a bounded number of phrases and no phrase is hot. With ``pairs``
    (the frequent pairs of words, a slice of them, the number of slices) only phrases that
    begin with one of the pairs are counted, and if there is one slice only those made up of
    such pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _corpora(batches, task_words):
            for lang, corpus in held.items():
                hashes = corpus.hashes()
                for shard, a in corpus.numbers():
                    for k, keys in wanted(lang, a, hashes):
                        if k in lengths:
                            yield from ranges(lang, shard, *np.unique(keys, return_counts=True))

    def wanted(lang: str, a: np.ndarray, hashes: np.ndarray) -> Iterator[tuple]:
        alive = pair = None
        for k, keys, whole in phrases_of(a, hashes, lengths[-1]):
            if pairs is not None and k == 2:
                pair = whole & member(keys, pairs[0].get(lang, np.empty(0, np.uint64)))
                alive = pair
            elif pairs is not None and k > 2:
                alive = alive[:-1] & (pair[k - 2:] if pairs[2] == 1 else whole)
            yield k, keys[whole if alive is None else alive]

    def ranges(lang, shard, keys, counts) -> Iterator[pa.RecordBatch]:
        part = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
        ends = np.flatnonzero(np.r_[part[1:] != part[:-1], True]) + 1 if len(keys) else []
        start, rows = 0, []
        for end in ends:
            rows.append((int(part[start]), keys[start:end].tobytes(),
                         counts[start:end].astype(np.int32).tobytes()))
            start = end
        if rows:
            number, blobs, amounts = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows)), pa.array([shard] * len(rows), pa.int32()),
                 pa.array(number, pa.int64()), pa.array(blobs, pa.binary()), pa.array(amounts, pa.binary())],
                names=["lang", "shard", "part", "keys", "counts"],
            )

    def add_up(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merged_counts(
            np.concatenate([np.frombuffer(b, np.uint64) for b in frame["keys"]]),
            np.concatenate([np.frombuffer(b, np.int32) for b in frame["counts"]]).astype(np.int64),
        )
        support = int(frame["support"].iloc[0])
        kept = counts >= support
        return pd.DataFrame({
            "lang": group[0], "shard": group[1], "key": keys[kept].view(np.int64),
            "count": counts[kept], "slack": support - 1,
        })

    counted = map_batches(
        texts, run, "lang string, shard int, part bigint, keys binary, counts binary"
    ).join(supports, ["lang", "shard"])
    reach_package(counted)
    return counted.groupBy("lang", "shard", "part").applyInPandas(
        add_up, "lang string, shard int, key bigint, count bigint, slack bigint"
    )


def _candidates(spark: SparkSession, local: DataFrame, supports: DataFrame, min_count: int) -> DataFrame:
    """(lang, key) of what may be frequent: all but those whose bounds add up to less."""
    all_slack = supports.groupBy("lang").agg(F.sum(F.col("support") - 1).alias("all_slack"))
    known = local.groupBy("lang", "key").agg(F.sum(F.col("count") - F.col("slack")).alias("above"))
    return stored(spark, known.join(all_slack, "lang").where(
        F.col("above") + F.col("all_slack") >= min_count
    ).select("lang", "key"), "phrase-candidates")


def _slices(spark: SparkSession, candidates: DataFrame, per_pass: int) -> Iterator[tuple]:
    """(keys by language, slice, slices): all candidates, about ``per_pass`` at a time.

    They go to every task, so their number at a time is what bounds their size; more than
    that make more passes over the texts.
    """
    slices = max(1, -(-candidates.count() // per_pass))
    for i in range(slices):
        part = candidates.where(F.pmod("key", F.lit(slices)) == i)
        table = part.select("lang", "key").toArrow()
        keys = table.column("key").to_numpy().view(np.uint64)
        langs = table.column("lang").to_pandas().to_numpy()
        yield {lang: np.sort(keys[langs == lang]) for lang in set(langs)}, i, slices


def _counted(texts: DataFrame, shared, task_words: int, longest: int, bits: int) -> DataFrame:
    """(lang, phrase, words, f): candidates and their counts; no phrase: all words of a language.

    Tasks send what they found by ranges of hashes; each range adds up its phrases.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, slices = shared.value
        for held in _corpora(batches, task_words):
            for lang, corpus in held.items():
                a = np.concatenate([part for _, part in corpus.numbers()])
                if number == 0:
                    yield row(lang, -1, b"", np.array([(a > 0).sum()]))
                if lang not in known:
                    continue
                names, alive = list(corpus.words), None
                for k, keys, whole in phrases_of(a, corpus.hashes(), longest):
                    if alive is not None and slices == 1:  # what a candidate begins with is one
                        whole = whole & alive[:len(whole)]
                    place = np.flatnonzero(whole)
                    place = place[member(keys[place], known[lang])]
                    alive = np.zeros(len(a), bool)
                    alive[place] = True
                    yield from found(lang, names, a, keys, place, k)

    def found(lang, names, a, keys, place, k) -> Iterator[pa.RecordBatch]:
        while len(place):
            hashed, first, at = np.unique(keys[place], return_index=True, return_inverse=True)
            first = place[first]
            # places whose words are those of the first with their hash; others go on
            same = np.ones(len(place), bool)
            for j in range(k):
                same &= a[place + j] == a[first[at] + j]
            counts = np.bincount(at[same], minlength=len(first))
            part = hashed >> np.uint64(64 - bits) if bits else np.zeros(len(first), np.uint64)
            start = 0
            for end in np.flatnonzero(np.r_[part[1:] != part[:-1], True]) + 1:
                words = [a[first[start:end] + j].tolist() for j in range(k)]
                phrases = [b" ".join([names[x] for x in p]) for p in zip(*words)]
                yield row(lang, int(part[start]), b"\n".join(phrases), counts[start:end])
                start = end
            place = place[~same]

    def row(lang, part, phrases, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([part], pa.int64()), pa.array([phrases], pa.binary()),
             pa.array([counts.astype(np.int64).tobytes()], pa.binary())],
            names=["lang", "part", "phrases", "counts"],
        )

    def add_up(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = {}
        for phrases, counts in zip(frame["phrases"], frame["counts"]):
            for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist()):
                total[phrase] = total.get(phrase, 0) + n
        phrases = [p.decode() or None for p in total]
        return pd.DataFrame({
            "lang": group[0], "phrase": pd.Series(phrases, dtype=object),
            "words": [p.count(" ") + 1 if p else 0 for p in phrases], "f": list(total.values()),
        })

    made = map_batches(texts, run, "lang string, part bigint, phrases binary, counts binary")
    reach_package(made)
    return made.groupBy("lang", "part").applyInPandas(
        add_up, "lang string, phrase string, words int, f bigint"
    )


def frequent_phrases(
    spark: SparkSession, docs: DataFrame, min_count: int = 100, longest: int = 5,
    lang_col: str = "lang", text_col: str = "text", shards: int = 4, lowered: int = 25,
    task_words: int = 6_000_000, per_pass: int = 4_000_000, part_bytes: int = 32 << 20,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words found ``min_count``
    times or more, and (lang, n), the words of each language.

    A shard's support is ``lowered`` percent of its share. ``task_words`` words are held at a
    time; ``part_bytes`` of text make a range of hashes.
    """
    text = quoted(text_col)
    texts = docs.select(
        F.coalesce(quoted(lang_col), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"), text.alias("text"),
    )
    # shares are shares of a language's bytes, so the supports add up to the whole one
    sizes = stored(spark, texts.groupBy("lang", "shard").agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint").alias("bytes")
    ), "phrase-bytes")
    whole = sizes.groupBy("lang").agg(F.sum("bytes").alias("all_bytes"))
    support = F.ceil(
        F.lit(min_count * lowered).cast("decimal(19,0)") * F.col("bytes") / (F.col("all_bytes") * 100)
    )
    supports = stored(spark, sizes.where("bytes > 0").join(whole, "lang").select(
        "lang", "shard", F.greatest(F.lit(1), support).cast("bigint").alias("support")
    ), "phrase-supports")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    bits = (total // part_bytes).bit_length()

    local = _mined(texts, supports, range(1, min(2, longest) + 1), task_words, bits)
    candidates = _candidates(spark, local, supports, min_count)
    if longest > 2:
        # words are among the candidates too; their hashes are no pair's
        for pairs in _slices(spark, candidates, per_pass):
            longer = _mined(texts, supports, range(3, longest + 1), task_words, bits, pairs)
            candidates = candidates.unionByName(_candidates(spark, longer, supports, min_count))
    counted = None
    for known in _slices(spark, candidates, per_pass):
        shared = spark.sparkContext.broadcast(known)
        some = _counted(texts, shared, task_words, longest, bits)
        counted = some if counted is None else counted.unionByName(some)
    counts = stored(
        spark, counted.where(F.col("phrase").isNull() | (F.col("f") >= min_count)), "phrase-counts"
    )
    return counts.where("phrase IS NOT NULL"), counts.where("phrase IS NULL").select(
        "lang", F.col("f").alias("n")
    )


def _key(phrase: Column) -> Column:
    return F.concat("lang", F.lit("\t"), phrase)  # no phrase holds a tab


def collocations(
    spark: SparkSession, docs: DataFrame, min_count: int = 100, longest: int = 5,
    covered: int = 100, lang_col: str = "lang", text_col: str = "text", **limits: int,
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of 2 to ``longest`` words.

    a is the phrase's count, n the language's words, l and r the counts of the phrase's two
    parts at the cut that gives the lowest score, floor(1000 * a * n / (l * r)); ties go to
    the shorter first part. Left out are phrases that lie within a longer one that is found
    in at least ``covered`` percent of their places. Arithmetic is exact. ``limits`` are those
    of ``frequent_phrases``; they decide the work, never the result.

    Texts are read whole, lower-cased in A-Z, cut into pieces at .,;:!? and line ends, and
    into words at spaces and tabs; null texts are empty, null languages are ``und``. Rows
    that repeat count as often as they occur; empty tables and languages without frequent
    phrases give no rows. Other columns are not read, whatever their names.
    """
    frequent, sizes = frequent_phrases(
        spark, docs, min_count, longest, lang_col, text_col, **limits
    )
    counts = frequent.select(_key(F.col("phrase")).alias("part"), F.col("f").alias("part_f"))
    several = frequent.where("words > 1").withColumn("w", F.split("phrase", " "))
    joined = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = several.select(
        "lang", "phrase", F.col("f").alias("a"), "words", "w",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", _key(joined(1, F.col("k"))).alias("left"),
        _key(joined(F.col("k") + 1, F.col("words"))).alias("right"),
    )
    cuts = lookup_join(cuts, counts, "left", "part").withColumnRenamed("part_f", "l")
    cuts = lookup_join(cuts, counts, "right", "part").withColumnRenamed("part_f", "r")
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products may pass 64 bits
    score = F.call_function(
        "div", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"), wide("l") * wide("r")
    )
    best = cuts.join(sizes, "lang").groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    inner = several.where("words > 2").select("lang", "f", "words", "w", F.explode(
        F.sequence(F.lit(2), F.col("words") - 1)
    ).alias("size")).select("lang", "f", "w", "size", F.explode(
        F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)
    ).alias("start")).select(
        "lang", joined(F.col("start"), F.col("size")).alias("phrase"), "f"
    ).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    alone = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    return best.join(inner, ["lang", "phrase"], "left").where(alone).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def top_collocations(phrases: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` of each language by score, count and phrase (bytes), with rank."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return first_n_per_group(phrases, ["lang"], order, top, rank="rank").withColumn(
        "rank", F.col("rank").cast("bigint")
    )
