"""Collocations against a count of all phrases in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from limelight.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}
OUT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def slow(docs, min_count, top=2000):
    count, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        kept = {p: a for p, a in f.items() if a >= min_count and len(p) > 1}
        covered = set()
        for q, b in kept.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    if b >= kept[q[i:i + size]]:
                        covered.add(q[i:i + size])
        rows = []
        for p, a in kept.items():
            if p not in covered:
                cuts = [(1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def slow_counts(docs, longest):
    count = Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(2, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang or "und", " ".join(words[i:i + k])] += 1
    return [(lang, None, p, a) for (lang, p), a in count.items()]


def found(spark, docs, min_count, top=2000, **options):
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = co.top_collocations(co.collocations(spark, df, min_count, **options), top)
    return sorted(tuple(r[c] for c in OUT) for r in got.collect())


def texts(seed, n, langs=("en", "de", None)):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "Éa", "c d", "x1", "of", "The", "e\x00f"]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        marks = [rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " set phrase here "]) for _ in words]
        out.append((rng.choice(langs), "".join(w + m for w, m in zip(words, marks))))
    return out


@pytest.mark.parametrize("min_count, limits", [
    (4, {}), (5, {"task_words": 60, "per_pass": 60, "shards": 3, "part_bytes": 500}),
    (2, {"task_words": 200, "shards": 16}), (12, {"shards": 1, "part_bytes": 64}), (6, {"lowered": 100, "shards": 5}),
])
def test_equals_counting_everything(spark, min_count, limits):
    docs = texts(min_count, 150)
    assert found(spark, docs, min_count, **limits) == slow(docs, min_count)


def test_phrases_that_share_a_hash_are_counted_apart(spark, monkeypatch):
    monkeypatch.setattr(co, "extended", lambda keys, words: (keys + words) % np.uint64(3))
    docs = texts(8, 40)
    df = spark.createDataFrame(docs, "lang string, text string")
    known = {lang or "und": np.arange(3, dtype=np.uint64) for lang, _ in docs}

    class Shared:
        value = (known, 0, 2)

    rows = df.selectExpr("coalesce(lang, 'und') AS lang", "0 AS shard", "text").collect()
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows])
    with monkeypatch.context() as patch:
        patch.setattr(co, "reach_package", lambda _: None)
        rows = []

        class Made(list):
            def groupBy(self, *_):
                rows.extend(r for b in self for r in b.to_pylist())
                return self

            def applyInPandas(self, *_):
                return None

        patch.setattr(co, "map_batches", lambda _, run, schema: Made(run(iter([batch]))))
        co._counted(None, Shared, 10 ** 6, 3, 1)
    got = Counter()
    for r in rows:
        for phrase, n in zip(r["phrases"].split(b"\n"), np.frombuffer(r["counts"], np.int64)):
            if b" " in phrase:
                got[r["lang"], phrase.decode()] += int(n)
    want = {(lang, p): a for lang, _, p, a, *_ in slow_counts(docs, 3)}
    assert got == want


def test_odd_rows(spark):
    docs = [(None, None), ("en", ""), ("en", None), (None, "a b. a b"), ("und", "a b"), ("en", "a a a a a"),
            ("en", "x y " * 5000), ("de", ".,;"), ("fr", "only once here")]
    for min_count in (1, 3):
        assert found(spark, docs, min_count) == slow(docs, min_count)
    assert found(spark, docs, 3, top=1) == slow(docs, 3, top=1)
    assert found(spark, [], 1) == []


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", "a b", 2, 4 * 10 ** 12), ("en", "a", 1, 5 * 10 ** 12), ("en", "b", 1, 6 * 10 ** 12)],
        "lang string, phrase string, words int, f bigint")
    sizes = spark.createDataFrame([("en", 7 * 10 ** 13)], "lang string, n bigint")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(co, "frequent_phrases", lambda *_, **__: (phrases, sizes))
        (row,) = co.collocations(spark, None).collect()
    assert row["score"] == 1000 * 4 * 10 ** 12 * 7 * 10 ** 13 // (30 * 10 ** 24)


def test_other_columns_and_clashing_names(spark):
    docs = texts(9, 60)
    df = spark.createDataFrame(docs, "lang string, text string").select(
        "*", F.lit(1).alias("phrase"), F.lit(2).alias("bytes"), F.lit(3).alias("a.b"))
    got = co.top_collocations(co.collocations(spark, df, 4))
    assert sorted(tuple(r[c] for c in OUT) for r in got.collect()) == slow(docs, 4)


def test_counts_are_merged():
    rng = np.random.default_rng(0)
    keys, counts = rng.integers(0, 50, 1000).astype(np.uint64), rng.integers(1, 9, 1000)
    want = Counter()
    for k, c in zip(keys.tolist(), counts.tolist()):
        want[k] += c
    got = co.merged_counts(keys, counts)
    assert got[0].tolist() == sorted(want) and dict(zip(got[0].tolist(), got[1].tolist())) == want
