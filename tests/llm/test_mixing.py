"""The mix against a queue served in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from limelight.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def slow_targets(sizes, weights, share, repeats):
    """Rounds of handing out what is above a source's limit, in exact fractions."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = Fraction(share) * sum(sizes.values()), set()
    while True:
        left = budget - sum(repeats * sizes[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(repeats * sizes[s]) if s in full else left * weight[s] / rest for s in order}
        above = {s for s in order if s not in full and target[s] > repeats * sizes[s]}
        if not above:
            return {s: float(t) for s, t in target.items()}
        full |= above


def slow(docs, weights=(5, 2, 1), share=1.5, repeats=2):
    queues = defaultdict(list)
    for doc, text, source in docs:
        size = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        key = hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()
        queues[source].append((key, size, doc))
    sizes = {s: sum(q[1] for q in queue) for s, queue in queues.items()}
    targets = slow_targets(sizes, weights, share, repeats) if sizes else {}
    out = defaultdict(int)
    for source, queue in queues.items():
        left = math.floor(targets[source])
        for _ in range(repeats):
            for place, (key, size, doc) in enumerate(sorted(queue, key=lambda q: q[:2])):
                out[(source, doc, size, place)] += min(size, left)
                left -= min(size, left)
    return sorted(((s, d, z, t) for (s, d, z, _), t in out.items()), key=str), sizes, targets


def mixed(spark, docs, **options):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    pieces = mixing.schedule(spark, df, **options).cache()
    names = {i: s for i, s in enumerate(sorted(
        {d[2] for d in docs}, key=lambda s: (s is None, (s or "").encode())))}
    rows = mixing.per_document(pieces).collect()
    return pieces, sorted(((names[r["place"]], r["id"], r["size"], r["taken"]) for r in rows), key=str), rows


def documents(seed, n, sources):
    rng = random.Random(seed)
    return [(i, " \t".join("wörd" for _ in range(int(rng.paretovariate(0.7)) % 400)), rng.choice(sources))
            for i in range(n)]


@pytest.mark.parametrize("seed, sources, options", [
    (1, ["a", "b", "c", None], {}),
    (2, ["a"] * 5 + ["B", "é", "z", "zz"], {"range_rows": 5}),
    (3, ["one"], {"share": 0.5, "range_rows": 20}),
    (4, ["a", "b"], {"weights": (1, 9, 2), "share": 2.9, "repeats": 3}),
    (5, ["a", "b", "c"], {"share": 5.0, "range_rows": 7}),
])
def test_words_taken_and_their_order(spark, seed, sources, options):
    docs = documents(seed, 120, sources)
    pieces, got, rows = mixed(spark, docs, **options)
    plain = {k: v for k, v in options.items() if k != "range_rows"}
    want, sizes, targets = slow(docs, **plain)
    assert got == want
    assert all(r["taken"] <= options.get("repeats", 2) * r["size"] for r in rows)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    for r in rows:
        assert r["target"] == pytest.approx(targets[order[r["place"]]])
        assert r["source_size"] == sizes[order[r["place"]]]
    mix = sorted((p for p in pieces.collect() if p["words"]), key=lambda p: p["position"])
    at, before = 0, 0.0
    for p in mix:  # gapless, in the order of virtual time
        assert p["position"] == at and before <= p["finish"] <= 1
        at, before = at + p["words"], p["finish"]
    for source in order:  # at any time, sources have given words in proportion to their targets
        given = 0
        biggest = max(d["size"] for d in rows if order[d["place"]] == source)
        for p in mix:
            given += p["words"] if order[p["place"]] == source else 0
            assert abs(given - p["finish"] * targets[source]) <= biggest + 1


def test_repeated_rows_nulls_and_empty_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    docs = [(7, "same words here", "a")] * 30 + [(None, "no id", "a"), (None, None, None), (8, "", "b"),
            (9, "x " * 5000, None), (10, None, "only nulls")]
    _, got, _ = mixed(spark, docs, range_rows=4)
    want, _, _ = slow(docs)
    assert got == want and len(got) == len(docs)


def test_empty_table_and_no_words(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.per_document(mixing.schedule(spark, df)).collect() == []
    _, got, _ = mixed(spark, [(1, None, "a"), (2, " ", "b")])
    assert [g[3] for g in got] == [0, 0]


def test_reruns_agree_and_clashing_columns_do_not_matter(spark):
    docs = documents(6, 80, ["a", "b", None])
    df = spark.createDataFrame(docs, SCHEMA)
    odd = df.repartition(5).select("*", F.lit(1).alias("size"), F.lit("x").alias("place"), F.lit(2).alias("a.b"))
    first, second = (sorted(map(tuple, mixing.schedule(spark, d).collect()), key=str) for d in (df, odd))
    assert first == second


def test_texts_in_the_order_of_the_mix(spark):
    docs = documents(7, 40, ["a", "b"])
    df = spark.createDataFrame(docs, SCHEMA)
    pieces = mixing.schedule(spark, df).cache()
    taken = pieces.where("words > 0").count()
    texts = mixing.mixed_texts(df, pieces).collect()
    by_id = {d[0]: d[1] for d in docs}
    assert len(texts) == taken
    assert [t["position"] for t in texts] == sorted(t["position"] for t in texts)
    for t in texts:
        words = by_id[t["id"]].split()
        assert t["text"].split() == words[:t["words"]]
        assert t["text"] == by_id[t["id"]] or t["words"] < len(words)


def test_no_python_workers(spark, data_dir):
    from limelight.llm.queries import queries

    df = queries()["op13_weighted_fair_mix"](spark, data_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
