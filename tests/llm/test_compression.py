"""The compression classifier against sizes and a calibration in plain Python."""

from __future__ import annotations

import math
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from limelight.llm import compression

MAGIC = b"\x37\xa4\x30\xec"  # what a trained dictionary begins with


def corpus(n, seed=0):
    """Good texts of words, bad texts of another alphabet; a third is bad, and some of each alike."""
    rng = random.Random(seed)
    good = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 8))) for _ in range(300)]
    bad = ["".join(rng.choices("xyz0123456789$", k=rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        label = int(i % 3 > 0)
        own, other = (good, bad) if label else (bad, good)
        share = rng.choice([0.5, 0.9, 1.0])
        words = [rng.choice(own if rng.random() < share else other) for _ in range(rng.randint(5, 400))]
        rows.append((i, " ".join(words), label))
    return rows


def frames(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    return df.select("doc_id", "text"), df.select("doc_id", "label")


def slow_size(text, dictionary):
    total = 0
    for start in range(0, len(text), 512):
        made = zstandard.ZstdCompressor(
            level=1, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
            write_dict_id=False).compress(text[start:start + 512])
        total += len(made)
    return total


def slow_difference(text, pairs):
    data = text.encode()
    if not data:
        return 0.0
    good, bad = (sum(slow_size(data, pair[kind]) for pair in pairs) for kind in (0, 1))
    return (bad - good) / max(good, bad)


def slow_fit(xs, ys, ridge=1e-3):
    """Bias and weight by plain Newton steps on sums."""
    b = w = 0.0
    n = len(xs)
    for _ in range(100):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, y in zip(xs, ys):
            p = 1 / (1 + math.exp(-max(-30, min(30, b + w * x))))
            g0, g1 = g0 + (p - y) / n, g1 + x * (p - y) / n
            q = p * (1 - p) / n
            h00, h01, h11 = h00 + q, h01 + q * x, h11 + q * x * x
        g0, g1, h00, h11 = g0 + ridge * b, g1 + ridge * w, h00 + ridge, h11 + ridge
        det = h00 * h11 - h01 * h01
        b, w = b - (h11 * g0 - h01 * g1) / det, w - (h00 * g1 - h01 * g0) / det
    return b, w


def test_scores_equal_plain_python(spark):
    rows = corpus(150)
    docs, labels = frames(spark, rows)
    model = compression.train(docs, labels)
    half = {r[0]: r[1] for r in docs.select(
        "doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))).collect()}
    fitted = [(slow_difference(t, (model.pairs[1 - half[i]],)), y) for i, t, y in rows]
    xs = [x for x, _ in fitted]
    centre = sum(xs) / len(xs)
    scale = math.sqrt(sum((x - centre) ** 2 for x in xs) / len(xs))
    b, w = slow_fit([(x - centre) / scale for x in xs], [y for _, y in fitted])
    assert (model.centre, model.scale) == pytest.approx((centre, scale))
    assert model.weights == pytest.approx((b, w), rel=1e-4)
    fresh = corpus(60, seed=5) + [(999, "", 1), (1000, None, 0)]
    scored = {r["doc_id"]: r["score"] for r in compression.score(frames(spark, fresh)[0], model).collect()}
    for i, text, _ in fresh:
        z = b + w * (slow_difference(text or "", model.pairs) - centre) / scale
        assert scored[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_one_kind_of_dictionary_at_any_size(spark):
    rows = corpus(60)
    copies = [(i + 1000 * k, t, y) for k in range(10) for i, t, y in rows]
    for table in (rows, copies):
        model = compression.train(*frames(spark, table))
        for good, bad in model.pairs:
            assert good[:4] == bad[:4] == MAGIC and len(good) == len(bad)


def test_classes_of_very_different_size_get_equal_dictionaries():
    rng = random.Random(1)
    piece = lambda letters: "".join(rng.choices(letters, k=512)).encode()
    good, bad = [piece("abcdefgh ") for _ in range(2000)], [piece("stuvwxyz ") for _ in range(20)]
    made = compression.train_dictionaries(good, bad, 64 << 10)
    assert len(made[0]) == len(made[1]) <= 20 * 512 // 4
    assert compression.train_dictionaries(good, bad[:1], 64 << 10) is None
    assert compression.train_dictionaries(good, [], 64 << 10) is None


def test_training_on_odd_rows(spark):
    rows = [*corpus(60), (None, "no id " * 50, 1), (70, None, 0), (71, "", 1), (72, "long " * 200_000, 1),
            (3, "another text of an id", 0), (3, "and one more", 0)]
    docs, labels = frames(spark, rows)
    odd = docs.select("*", F.lit(1).alias("piece"), F.lit("x").alias("__difference"), F.lit(2).alias("a.b"))
    model = compression.train(odd, labels.select("*", F.lit(0).alias("text"), F.lit(1).alias("id")))
    again = compression.train(odd.repartition(5), labels.repartition(3))
    assert model.pairs == again.pairs and model.weights == pytest.approx(again.weights)
    scored = compression.score(odd, model)
    assert scored.count() == len(rows) and scored.columns == [*odd.columns, "score", "predicted"]
