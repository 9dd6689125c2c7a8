"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from limelight.llm import (
    compression, licenses, line_dedup, packing, quality_lines, sharding, simhash, tiling,
    token_counts, urls,
)
from limelight.llm.common import labelled_sample
from limelight.llm.components import components, forest
from limelight.llm.license_wordings import WORDINGS

P = pytest.importorskip("public_tokenizers")
LONG = ("word%d " * 60_000) % tuple(range(60_000))
ODD = [None, "", " \n\t ", "one", LONG, "same text here", "same text here", "é ñ\x00\x01 日本"]


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 0, or from (id, text) pairs."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"

    def build(*texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", None, 0) for i, t in pairs], schema)

    return build


@pytest.fixture
def odd(docs, spark):
    """Odd texts, a null id, a repeated row, and columns named like what operators add."""
    plain = docs(*ODD).unionByName(docs((None, "no id")), True).unionByName(docs((3, "one")))
    for name in (
        "size", "shard", "slot", "n_lines", "n_dropped", "n_words", "N_TOKENS", "kept", "score",
        "labels", "hits", "fingerprint", "fp", "id", "row", "start", "ids", "host", "verdict",
        "__hash", "__drop", "__url", "position", "a.b",
    ):
        plain = plain.withColumn(name, F.lit("mine"))
    return plain


N_ODD = len(ODD) + 2


def everything(spark, df):
    """Every operator over documents, as (name, result)."""
    field = quality_lines.Field(np.zeros(quality_lines.N_FEATURES), np.zeros((2, 2)))
    words, bytes_ = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
    items = spark.createDataFrame([(1, "w x y z v u"), (None, "a b c d e"), (3, None)], "item_id long, text string")
    yield "quality_lines", quality_lines.judge(df, field)
    yield "licenses", licenses.scan_licenses(df)
    yield "compression", compression.score(df, None)
    yield "simhash", simhash.near_duplicates(spark, df)
    yield "keep_first", simhash.keep_first(spark, df)
    yield "packing", packing.pack(df, words)
    yield "sharding", sharding.shard(spark, df, 3)
    yield "line_dedup", line_dedup.drop_repeated_lines(spark, df)
    yield "tiling", tiling.with_hits(spark, df, items)
    yield "tiling_joined", tiling.with_hits(spark, df, items, broadcast_bytes=-1)
    yield "token_counts", token_counts.with_token_counts(df, bytes_, P.PATTERN)


def test_odd_rows_pass_every_operator(spark, odd):
    for name, made in everything(spark, odd):
        rows = made.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == {None, *range(len(ODD))}
        elif name == "keep_first":
            assert len(rows) == 6  # wordless ones are one group, so are the equal texts
        else:
            assert len(rows) == N_ODD, name
        if "a.b" in made.columns:
            assert {r["a.b"] for r in rows} == {"mine"}
            assert len(set(map(str.lower, made.columns))) == len(made.columns)


def test_empty_tables(spark, docs):
    empty = docs("y").where("text = ''")
    for name, made in everything(spark, empty):
        assert made.count() == 0, name
    labels = spark.createDataFrame([(0, 1), (None, 0), (3, None), (4, 7)], "doc_id long, label int")
    for documents, marks in ((empty, labels), (docs("a b"), labels), (docs("a b"), labels.limit(0))):
        assert quality_lines.train(documents, marks) is None
        assert compression.train(documents, marks) is None
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.filter_urls(spark, pages, pages, ()).count() == 0


@pytest.mark.parametrize("each", [False, True])
def test_a_sample_has_one_row_per_id(spark, docs, each):
    hot = [(7, f"text {i} of a repeated id") for i in range(300)]
    rows = docs(*hot, *[(i, f"own text {i}") for i in range(7)], (7, None))
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label")).distinct()
    made = [
        sorted(map(tuple, labelled_sample(r, labels, 8, each).collect()))
        for r in (rows, rows.repartition(5).orderBy(F.desc("text")))
    ]
    assert [r[0] for r in made[0]] == list(range(8)) and made[0] == made[1]
    assert made[0][7][1] in dict((t, i) for i, t in hot)


# --- quality rules ---------------------------------------------------------------------


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        field = quality_lines.Field(rng.normal(size=quality_lines.N_FEATURES), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, quality_lines.N_FEATURES))
        gain = x @ field.weights

        def total(path):
            return sum(gain[i] for i in range(n) if path[i]) + sum(
                field.moves[a, b] for a, b in zip(path, path[1:])
            )

        paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
        assert total(field.decode(x).tolist()) == pytest.approx(max(map(total, paths)))


def test_expected_counts_are_the_gradient_of_the_partition():
    rng = np.random.default_rng(2)
    unary, moves = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    mask = np.arange(5) < np.array([[5], [3], [1]])
    shares, counts, total = quality_lines._expected(unary, moves, mask)
    step = 1e-6
    for i, t in ((0, 0), (0, 4), (1, 2)):
        moved = unary.copy()
        moved[i, t] += step
        change = (quality_lines._expected(moved, moves, mask)[2] - total).sum() / step
        assert change == pytest.approx(shares[i, t], abs=1e-4)
    for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
        moved = moves.copy()
        moved[a, b] += step
        change = (quality_lines._expected(unary, moved, mask)[2] - total).sum() / step
        assert change == pytest.approx(counts[a, b], abs=1e-4)


def test_lines_between_many_neighbours_are_shared_but_not_lines_of_copies():
    copies = [np.array([1, 2, 3], np.uint64)] * 9
    spread = [np.array([10 + i, 7, 30 + i], np.uint64) for i in range(5)]
    assert quality_lines.shared_lines(copies + spread, 5).tolist() == [7]


# --- licenses --------------------------------------------------------------------------


def test_rules_are_hundreds_with_unique_names():
    rules = licenses.signature_rules()
    assert len(rules) >= 600 and len(WORDINGS) >= 200 and len({r.name for r in rules}) == len(rules)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}),
    ("GNU General Public License, version 3 or any later version", {"gpl", "gpl-3-or-later"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("SPDX-License-Identifier: MIT", {"mit"}),
    ("Released under the MIT License.", {"mit"}),
    ("All rights reserved.", {"proprietary"}),
    ("Ich komme mit Lizenzen", set()),
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
])
def test_labels(spark, docs, text, labels):
    row = licenses.scan_licenses(docs(text)).first()
    assert set(row["labels"]) == labels


def test_suppression_keeps_the_stronger_of_contained_intervals():
    def rule(name, priority):
        return licenses.Rule(name, name, "x", ("x",), priority, 1.0)

    found = [
        licenses.Detection(rule("weak-inside", 1), 2, 4), licenses.Detection(rule("strong", 5), 1, 6),
        licenses.Detection(rule("strong-inside", 9), 3, 5), licenses.Detection(rule("overlaps", 1), 5, 8),
        licenses.Detection(rule("twin", 5), 1, 6),
    ]
    assert [d.rule.name for d in licenses.suppress(found)] == ["strong", "strong-inside", "overlaps"]


def test_keywords_never_hide_a_rule():
    rules = licenses.signature_rules()
    open_ = tuple(licenses.Rule(**{**r.__dict__, "keywords": ("",)}) for r in rules)
    gated, free = licenses.Scanner(rules), licenses.Scanner(open_)
    for text in (
        b"gnu gpl v2 asl 2.0 mpl 1.1 epl cddl 1.0 eupl 1.2 lgpl agpl-3.0 gfdl 1.3 php license 3.0",
        b"licensed under the mit. bsd 3 clause, zlib/libpng license, wtfpl, in the public domain",
        b"creative commons attribution share alike 3.0 unported; cc zero; artistic license 2.0",
    ):
        found, want = (
            sorted((d.rule.name, d.start, d.end) for d in s.scan(text)[1]) for s in (gated, free)
        )
        assert found == want


def found_by(scanner, text):
    _, found = scanner.scan(text.encode())
    return {d.rule.label for d in licenses.suppress(found)}


def test_every_wording_has_an_example_that_only_it_labels():
    rules = licenses.signature_rules()
    every = licenses.Scanner(rules)
    for name, label, _, _, keyword, _, example in WORDINGS:
        _, found = every.scan(example.encode())
        assert label in {d.rule.label for d in licenses.suppress(found)}, name
        assert {d.rule.name for d in found if d.rule.label == label} == {name}, name
        assert keyword.isascii() and keyword == keyword.lower()


def test_wordings_leave_prose_alone():
    scanner = licenses.Scanner(tuple(r for r in licenses.signature_rules() if not r.base))
    for text in (
        "The driver showed a valid license to the officer, who granted permission to go on.",
        "A public library lends books free of charge; copies may be reserved in person.",
        "Redistribution of wealth was debated, and the source of the data in binary was unclear.",
        "They use commercial software, share an open source project and train models on it.",
    ):
        assert found_by(scanner, text) == set(), text


def slow_scan(text, rules):
    """Words, places of base phrases, labels and spans: no gate, every pair of detections compared."""
    words = [w for w in re.split(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.encode().lower()) if w]
    body = b" ".join(words)
    begins, place = {0: 0}, 0
    for i, word in enumerate(words):
        place += len(word) + 1
        begins[place] = i + 1
    ends = {at - 1: i for at, i in begins.items()}
    found = []
    for order, rule in enumerate(rules):
        pattern, at = re.compile(rb"(?:^|(?<= ))(?:" + rule.pattern.encode() + rb")(?= |$)"), 0
        while m := pattern.search(body, at):
            first = begins[m.start()]
            found.append((rule, order, first, ends[m.end()]))
            at = m.start() + len(words[first]) + 1

    def stronger(a, b):
        return (-a[0].priority, a[2] - a[3], a[1]) < (-b[0].priority, b[2] - b[3], b[1])

    kept = [
        d for d in found
        if not any(o is not d and o[2] <= d[2] and d[3] <= o[3] and stronger(o, d) for o in found)
    ]
    labels = {d[0].label for d in kept} | {d[0].label for d in found if d[0].base}
    places = sorted(d[2] for d in found if d[0].base)
    spans = sorted((d[0].name, d[2], d[3]) for d in kept)
    return len(words), places, sorted(labels), spans, max((d[0].weight for d in kept), default=0.0)


def test_scan_equals_a_slow_one_over_a_table(spark, data_dir):
    rules = licenses.signature_rules()
    texts = [r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("text").collect()]
    rng = random.Random(5)
    examples = [row[-1] for row in WORDINGS]
    texts = texts[:40] + [
        " ".join([rng.choice(texts)[:80], *rng.sample(examples, 3), "GNU General Public License v2"])
        for _ in range(40)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in licenses.scan_licenses(df).collect():
        spans = sorted((d["rule"], d["start"], d["end"]) for d in row["detections"])
        got = (row["n_words"], row["places"], row["labels"], spans, row["score"])
        assert got == slow_scan(texts[row["doc_id"]], rules)


def phrases(pattern):
    """Texts for every branch and every optional part of a pattern, repeats once."""
    from itertools import product
    from re import _parser

    def of(items):
        for picks in product(*[list(one(*item)) for item in items]):
            yield "".join(picks)

    def one(kind, value):
        kind = str(kind)
        if kind == "LITERAL":
            yield chr(value)
        elif kind == "IN":
            yield from {"LITERAL": chr(value[0][1])}.get(str(value[0][0]), "1" if "DIGIT" in str(value) else "x")
        elif kind == "SUBPATTERN":
            yield from of(value[3])
        elif kind == "BRANCH":
            for branch in value[1]:
                yield from of(branch)
        elif kind == "MAX_REPEAT":
            if value[0] == 0:
                yield ""
            yield from of(value[2])
        else:
            assert kind in ("AT", "ASSERT_NOT"), kind
            yield ""

    return of(_parser.parse(pattern))


def test_the_gate_of_a_rule_is_open_for_all_it_matches():
    verbs = licenses.GRANT[:licenses.GRANT.index(")") + 1]
    closed = set()
    for rule in licenses.signature_rules():
        pattern = rule.pattern.replace(verbs, "licensed")  # the verb decides no gate
        for text in phrases(pattern):
            assert re.match(pattern, text), (rule.name, text)
            if not any(k in text for k in rule.keywords):
                closed.add((rule.name, text))
    assert not closed


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the terms of the MIT License", {"mit"}),
    ("released under terms of the MIT", {"mit"}),
    ("Distributed under the terms of the MIT licence.", {"mit"}),
])
def test_mit_grants_by_their_terms(spark, docs, text, labels):
    row = licenses.scan_licenses(docs(text)).first()
    assert (set(row["labels"]), row["score"]) == (labels, 1.0)


# --- URLs ------------------------------------------------------------------------------


@pytest.mark.parametrize("budget", [8 << 20, 0])
def test_list_has_no_false_positives_or_misses(spark, budget):
    rng = random.Random(3)
    every = [f"http://h{rng.randrange(40)}.org/p{rng.randrange(60)}" for _ in range(3000)]
    every += ["http://hot.org/x"] * 1500 + [None, "", "no scheme", "http://", "HTTP://WWW.H1.ORG:80/p1/?q#f"]
    pages = spark.createDataFrame(list(enumerate(every)), "page_id long, url string").withColumn(
        "listed", F.lit("clash")
    )
    listed = [u for u in every[:200]] + ["http://hot.org/x.html", None]
    made = urls.filter_urls(
        spark, pages, spark.createDataFrame([(u,) for u in listed], "url string"), (),
        bits_per_key=4, broadcast_bytes=budget,  # few bits: many false hits to remove
    ).toPandas()
    wanted = {u for u in listed if u} | {"http://hot.org/x"}
    assert len(made) == len(every)
    for r in made.itertuples():
        want = r.url in wanted or r.url == "HTTP://WWW.H1.ORG:80/p1/?q#f" and "http://h1.org/p1" in wanted
        assert r.listed == want, r.url


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    made = urls.filter_urls(spark, pages, pages, ())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- compression -----------------------------------------------------------------------


def test_classifier_tells_shouting_from_prose(spark, docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    good = [" ".join(rng.choices(vocabulary, k=120)) for _ in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choices(vocabulary, k=120)) for _ in range(60)]
    rows = docs(*good, *bad)
    labels = rows.select("doc_id", (F.col("doc_id") < 60).cast("int").alias("label"))
    model = compression.train(rows, labels)
    fresh = docs(" ".join(rng.choices(vocabulary, k=90)), " ".join(w.upper() + "!!" for w in vocabulary[:90]))
    assert [r["predicted"] for r in compression.score(fresh, model).orderBy("doc_id").collect()] == [1, 0]
    assert compression.train(rows, labels.where("label = 1")) is None


def test_scores_keep_the_shares_of_the_labels_in_a_bounded_sample(spark, docs):
    rng = random.Random(12)
    words = [["".join(rng.choice(c) for _ in range(6)) for _ in range(150)] for c in ("abcdef", "ghijkl")]

    def text(good):
        share = min(1, max(0, rng.gauss(0.58 if good else 0.42, 0.16)))
        return " ".join(rng.choice(words[rng.random() > share]) for _ in range(60))

    n, good = 1400, 1200
    rows = docs(*[text(i < good) for i in range(n)])
    labels = rows.select("doc_id", (F.col("doc_id") < good).cast("int").alias("label"))
    fresh = docs(*[text(i % 7 > 0) for i in range(280)])
    made = []
    for documents in (120, 3000):
        model = compression.train(rows, labels, documents=documents, dictionary_bytes=4096)
        made.append(np.array([
            (r["score"], r["predicted"]) for r in compression.score(fresh, model).orderBy("doc_id").collect()
        ]))
    small, large = made
    assert abs(small[:, 0].mean() - large[:, 0].mean()) < 0.06
    assert (small[:, 1] == large[:, 1]).mean() > 0.85


def test_a_counted_row_weighs_as_much_as_its_copies():
    rng = np.random.default_rng(13)
    x = np.c_[np.ones(60), rng.normal(size=(60, 2))]
    y = (x[:, 1] + rng.normal(size=60) > 0).astype(float)
    counts = np.where(y == 1, 3, 1)
    copied = compression.logistic(x.repeat(counts, axis=0), y.repeat(counts))
    assert compression.logistic(x, y, counts=counts) == pytest.approx(copied)


# --- SimHash and components ------------------------------------------------------------


def brute_components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("task_links", [1 << 20, 100])
def test_components_of_paths_stars_and_noise(spark, task_links):
    rng = random.Random(5)
    path = list(range(100, 400))
    rng.shuffle(path)
    pairs = list(zip(path, path[1:])) + [(7, 1000 + i) for i in range(300)]
    pairs += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    pairs += [(5, 5), (-3, 7)]
    want = brute_components([p for p in pairs if p[0] != p[1]])
    made = components(spark, spark.createDataFrame(pairs, "a long, b long"), task_links=task_links)
    assert {r["node"]: r["root"] for r in made.collect()} == want
    a, b = np.array(pairs).T
    assert brute_components(map(tuple, forest(a, b).tolist())) == want


def fingerprints(seed, n=400):
    """Random values, clusters a few bits around centres, and chains."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            out.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
    at = rng.getrandbits(64)
    for _ in range(30):
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
        out.append(at)
    return sorted(set(out) | {0, 1, (1 << 64) - 1})


@pytest.mark.parametrize("parts, bucket, block", [
    ((2,), 48, 4096), ((3,), 48, 4096), ((4,), 3, 4096), ((5,), 2, 5), ((6,), 48, 4096),
])
def test_search_gives_every_component(spark, parts, bucket, block):
    values = fingerprints(parts[0])
    array = np.array(values, np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    want = brute_components(
        (int(array[i:i + 1].view(np.int64)[0]), int(array[j:j + 1].view(np.int64)[0]))
        for i, j in zip(*np.nonzero(near)) if i != j
    )
    plan = simhash.make_plan(array, 10_000_000, parts=parts)
    assert sum(plan.thresholds) == 4 - parts[0] + 1 and sorted(sum(plan.groups, ())) == list(range(64))
    prints = spark.createDataFrame([(int(x),) for x in array.view(np.int64)], "fp long")
    found = simhash.links(spark, prints, plan, bucket=bucket, block=block)
    made = components(spark, found)
    assert {r["node"]: r["root"] for r in made.collect()} == want


def test_both_sides_of_a_hot_bucket_are_cut_into_blocks(spark, monkeypatch):
    def sizes(distance):
        def run(pdf):
            sides = pdf["side"].to_numpy()
            return pd.DataFrame({"a": [-(sides == 0).sum() - 1], "b": [-(sides == 1).sum() - 1]})
        return run

    monkeypatch.setattr(simhash, "_block_pairs", sizes)
    low, high = tuple(range(32)), tuple(range(32, 64))
    # 60 fingerprints of one value beside 2,000 of a value one bit away
    values = [i << 33 for i in range(1, 61)] + [i << 33 | 1 for i in range(61, 2061)]
    prints = spark.createDataFrame([(x,) for x in values], "fp long")
    found = simhash.links(spark, prints, simhash.Plan((low, high), (1, -1)), block=100)
    groups = [(-r["a"] - 1, -r["b"] - 1) for r in found.collect() if r["a"] < 0]
    assert max(max(g) for g in groups) <= 200
    # each of the 2,060 looks into both buckets: once per block listed there
    assert sum(g[0] for g in groups) == 2060 * 1 + 2060 * 20


def test_thresholds_follow_the_bits():
    rng = np.random.default_rng(6)
    poor = rng.integers(0, 2, size=(2000, 1)).repeat(16, axis=1) ^ (rng.random((2000, 16)) < 0.02)
    rich = rng.integers(0, 2, size=(2000, 48))
    bits = np.concatenate([poor, rich], axis=1).astype(np.uint8)
    values = np.packbits(bits[:, ::-1], axis=1).view(">u8").ravel().astype(np.uint64)
    groups = simhash.group_bits(simhash.bit_matrix(values).astype(float), 4)
    assert tuple(range(16)) in groups  # bits that vary together share a partition
    plan = simhash.make_plan(values, 10_000_000, parts=(4,))
    assert plan.thresholds[plan.groups.index(tuple(range(16)))] == min(plan.thresholds) < max(plan.thresholds)


def test_keep_first_keeps_one_of_each(spark, docs):
    body = " ".join(f"w{i}" for i in range(300))
    made = simhash.keep_first(spark, docs((9, body), (4, body), (4, body), (2, "other words altogether here"), (None, body), (None, None)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in made.collect()) == [
        (False, 2), (False, 4), (True, 0)]


def test_keep_first_keeps_unrelated_texts_of_one_id(spark, docs):
    one, two = (" ".join(f"{c}{i}" for i in range(300)) for c in "vw")
    near = two + " end"
    rows = docs((1, one), (1, two), (5, near), (6, one), (1, one), (None, "three words here"), (None, near))
    rows = rows.unionByName(docs((1, two)).withColumn("lang", F.lit("de")))
    made = [
        sorted(map(tuple, simhash.keep_first(spark, r).collect()), key=str)
        for r in (rows, rows.repartition(5).orderBy(F.desc("text"), "lang"))
    ]
    assert made[0] == made[1]
    texts = {(r[0], r[1]) for r in made[0]}
    assert len(made[0]) == 3 and (None, "three words here") in texts and (1, one) in texts
    assert (1, two) in texts


# --- packing ---------------------------------------------------------------------------


def test_packer_fills_windows_whatever_the_lengths():
    rng = random.Random(7)
    for tiers in ((256, 512, 1024, 2048, 4096), (8, 64), (4096,)):
        packer = packing.TierPacker(tiers)
        sizes = [rng.choice([1, 3, 50, 300, 700, 5000, 4096, 20_000]) for _ in range(200)]
        windows, where = [], defaultdict(list)
        for doc, size in enumerate(sizes):
            windows += packer.add(packing.Piece(doc, 0, bytes(4 * size)))
            if doc % 20 == 19:
                windows += packer.drain(leave=3000)
        windows += packer.finish()
        assert not packer.waiting and not packer.pieces and packer.tokens == 0
        short = 0
        for window in windows:
            total = sum(map(len, window))
            if total & (total - 1):  # of the longest tier, a few places short
                assert tiers[-1] - max(2, tiers[-1] // 32) < total < tiers[-1]
            else:
                assert total <= tiers[-1]
                short += total not in tiers
            for piece in window:
                where[piece.doc].append((piece.start, len(piece)))
        assert short <= 12
        for doc, size in enumerate(sizes):
            at = 0
            for start, length in sorted(where[doc]):
                assert start == at
                at += length
            assert at == size


def test_pieces_are_not_shredded():
    """Texts of ordinary lengths: few that fit a window are cut, none into slivers but at the end."""
    rng = random.Random(11)
    sizes = [min(30_000, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(6000)]
    packer = packing.TierPacker((256, 512, 1024, 2048, 4096))
    windows = []
    for doc, size in enumerate(sizes):
        windows += packer.add(packing.Piece(doc, 0, bytes(4 * size)))
        if packer.tokens > 1 << 18:
            windows += packer.drain(leave=1 << 16)
    windows += packer.drain()
    ends = len(windows)
    windows += packer.finish()
    parts = defaultdict(list)
    for number, window in enumerate(windows):
        for piece in window:
            parts[piece.doc].append((len(piece), number))
    cut = [doc for doc, size in enumerate(sizes) if size < 4096 and len(parts[doc]) > 1]
    slivers = [n for doc, size in enumerate(sizes) if len(parts[doc]) > 1
               for n, number in parts[doc] if n < 16 and number < ends]
    whole_rest = sum(size % 4096 < 16 for size in sizes if size >= 4096)
    assert len(cut) < 0.05 * len(sizes) and len(slivers) <= whole_rest
    padded = sum(4096 - t for w in windows if (t := sum(map(len, w))) & (t - 1))
    assert padded < 0.02 * sum(sizes)


def test_steps_are_balanced():
    sizes = [4096] * 40 + [1024] * 37 + [256] * 100
    steps = packing.balanced(sizes, 1 << 15)
    loads = defaultdict(int)
    for size, step in zip(sizes, steps):
        loads[step] += size
    assert max(loads.values()) - min(loads.values()) <= 256


def test_sequences_hold_the_ids_in_order(spark, docs):
    path = P.path("word_bpe_49k.json")
    pieces = packing.pack(docs("a b c", None, "d e " * 3000), path)
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        at = 4 * r["offset"]
        assert made[r["sequence_id"]][at:at + 4 * r["length"]] == bytes(r["ids"])


# --- sharding --------------------------------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"probes": 64}, {"piece_rows": 90}, {"piece_rows": 1}])
def test_shards_are_even_with_a_hot_text(spark, docs, options):
    rng = random.Random(8)
    texts = ["hot text " * 5] * 700 + ["x" * rng.randrange(200) for _ in range(1300)] + [None] * 50
    rng.shuffle(texts)
    made = sharding.shard(spark, docs(*texts), 5, **options).toPandas()
    loads = made.groupby("shard")["size"].sum()
    assert len(loads) == 5 and loads.max() - loads.min() <= 3 * made["size"].max()
    for _, rows in made.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    spread = made.groupby("text", dropna=False)["shard"].nunique()
    assert (spread > 1).sum() <= 4  # only texts on a boundary


def test_rows_of_one_key_stay_together(spark, docs):
    made = sharding.shard(spark, docs(*[(1, "same")] * 20, *[(2, "b" * 30)] * 5), 3).toPandas()
    assert len(made) == 25 and made.groupby("text")["shard"].nunique().max() == 1
    for _, rows in made.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))


def test_ids_of_any_type_are_sharded(spark):
    rows = [(f"id-{i}", "same text") for i in range(300)] + [(None, "x" * i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    made = sharding.shard(spark, df, 4, piece_rows=10).toPandas()
    loads = made.groupby("shard")["size"].sum()
    assert len(made) == 340 and len(loads) == 4 and loads.max() - loads.min() <= 3 * made["size"].max()
    for _, rows in made.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))


def test_pieces_stay_small_however_many(spark, docs):
    """Also where one text holds most rows: its piece is parted by the ids."""
    made = sharding.shard(spark, docs(*["hot"] * 3000, *[f"t{i}" for i in range(500)]), 3, piece_rows=20)
    assert made.count() == 3500
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "__cell" in plan and "__part" in plan and "Window" in plan
    keys = sharding._cells(sharding.keyed(docs(*["hot"] * 3000), "text", "doc_id"), 5, F.lit(0))
    parts = keys.withColumn("__bits", F.lit(8)).select("__cell", sharding._part().alias("p")).groupBy(
        "__cell", "p").count()
    assert parts.agg(F.max("count")).first()[0] < 60  # of 3000 rows of one text


def test_sharding_runs_no_python(spark, docs):
    made = sharding.shard(spark, docs("a", "b", "c"), 2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- line dedup ------------------------------------------------------------------------


@pytest.mark.parametrize("documents", [2, 3])
def test_line_threshold_and_positions(spark, docs, documents):
    rng = random.Random(9)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["short", "", "ÀÉÎÕÜÀÉÎÕ", "ÀÉÎÕÜÀÉÎÕÜ"]
    texts = ["\n".join(rng.choice(("", " ", "\t")) + rng.choice(pool).upper() for _ in range(12)) for _ in range(30)]
    lower = {c: c + 32 for c in range(65, 91)}
    key = lambda x: x.strip(" \t\n\r\v\f").translate(lower)
    holders = defaultdict(set)
    for i, t in enumerate(texts):
        for x in t.split("\n"):
            holders[key(x)].add(i)
    made = line_dedup.drop_repeated_lines(spark, docs(*texts), documents=documents).toPandas()
    for r in made.itertuples():
        kept = [
            x for x in texts[r.doc_id].split("\n")
            if len(key(x)) < 10 or len(holders[key(x)]) < documents or min(holders[key(x)]) == r.doc_id
        ]
        assert r.text == "\n".join(kept) and r.n_dropped == 12 - len(kept)


# --- tiling ----------------------------------------------------------------------------


def slow_tiles(a, b, width):
    """Greedy string tiling by its definition."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (width - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < width:
            return out
        free_a[i:i + k] = [False] * k
        free_b[j:j + k] = [False] * k
        out.append((i, j, k))


def test_tiles_by_definition():
    rng = np.random.default_rng(10)
    for _ in range(60):
        a = rng.integers(1, 4, rng.integers(0, 40)).astype(np.uint64)
        b = rng.integers(1, 4, rng.integers(0, 25)).astype(np.uint64)
        assert tiling.tiles(a, b, 3) == slow_tiles(a.tolist(), b.tolist(), 3)


@pytest.mark.parametrize("budget", [32 << 20, -1])
def test_reordered_passages_are_caught(spark, docs, budget):
    item = [f"q{i}" for i in range(40)]
    filler = [f"f{i}" for i in range(400)]
    moved = filler[:100] + item[20:] + filler[100:200] + item[:20] + filler[200:]
    partly = filler + item[:30]
    words = lambda x: " ".join(x)
    items = spark.createDataFrame(
        [(1, words(item)), (2, "too short"), (3, words(item).upper()), (4, "a b a b a b a b"), (5, None)],
        "item_id long, text string",
    )
    made = tiling.with_hits(
        spark, docs(words(moved), words(partly), words(filler), words(moved), "a b " * 500, None), items,
        broadcast_bytes=budget,
    ).orderBy("doc_id").collect()
    assert [[h["item_id"] for h in r["hits"]] for r in made] == [[1, 3], [], [], [1, 3], [4], []]
    assert sorted((t["doc_start"], t["item_start"], t["length"]) for t in made[0]["hits"][0]["tiles"]) == [
        (100, 20, 20), (220, 0, 20)]


def test_a_hot_seed_makes_no_product(spark, docs):
    rng = random.Random(2)
    common = "we hold these truths to be self evident"
    fresh = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    bodies = [f"{fresh(30)} {common} {fresh(30)}" for _ in range(60)]
    items = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "item_id long, text string")
    texts = [f"{fresh(20)} {common} {fresh(20)}" for _ in range(120)] + [fresh(9) + " " + bodies[7]]
    keyed = docs(*texts).select(F.col("doc_id").cast("string").alias("key"), "text")
    pairs = tiling._candidate_pairs(
        spark, keyed, items.select("item_id", F.col("text").alias("item_text")), 5, 0.8)
    assert [tuple(r) for r in pairs.collect()] == [("120", 7)]  # of 121 x 60
    made = tiling.with_hits(spark, docs(*texts), items, broadcast_bytes=-1).where(F.size("hits") > 0).collect()
    assert [(r["doc_id"], [h["item_id"] for h in r["hits"]]) for r in made] == [(120, [7])]


def test_joined_hits_equal_broadcast_ones(spark, docs):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(30)]
    passage = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [passage(n) for n in (5, 6, 8, 12, 20) for _ in range(3)]
    items = [(i, " ".join(p + (passage(rng.randrange(4)) if i % 2 else []))) for i, p in enumerate(shared)]
    texts = []
    for _ in range(60):
        parts = [passage(rng.randrange(20))]
        for p in rng.sample(shared, 2):
            cut = rng.randrange(len(p) + 1)
            parts += [p[cut:], passage(3), p[:cut]] if rng.random() < 0.5 else [p, passage(4)]
        texts.append(" ".join(w for part in parts for w in part))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    both = [
        sorted((r["doc_id"], str(r["hits"])) for r in tiling.with_hits(
            spark, docs(*texts), benchmark, broadcast_bytes=budget).collect())
        for budget in (32 << 20, -1)
    ]
    assert both[0] == both[1] and any(h != "[]" for _, h in both[0])


def test_item_ids_are_integers(spark, docs):
    items = spark.createDataFrame([("a", "one two three four five")], "item_id string, text string")
    with pytest.raises(ValueError, match="item ids must be integers"):
        tiling.with_hits(spark, docs("x"), items)


# --- token counts ----------------------------------------------------------------------


def test_counts_equal_the_library_on_odd_texts():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(11)
    texts = [
        "", "a", "aaaaaaaaaaaaaaa", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>  z", "  \n\n  x",
        "\x1c \x1d a\x85b  c᠎ d​", "é" * 50, "don't I'll we've'S", "日本語 123 ½ ²", "mississippi" * 90,
        "ab" * 900, "🙂🙂 🙂", "\x00\x01",
    ] + ["".join(rng.choice("ab ' \n.é1") for _ in range(300)) for _ in range(40)]
    counter = token_counts.TokenCounter(token_counts.Vocabulary.read(path, P.PATTERN), remembered=50)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.count(texts) == want and counter.count(texts) == want  # also when remembered


def test_word_ids_equal_the_library_on_odd_texts():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.WordTokenizer(path, remembered=10)
    for t in (
        "", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>", "\x1c \x1d a\x85b c᠎", "don't I'll 'tis w's",
        "日本語 123 ½ ²", "á ́b", "Ⅷ ٠١", "ǅ ΣΑΣ ΟΔΟΣ İstanbul ẞ", "\x00\x01", "a1b2 x.y, z! &&&. 10%", "ﬁ ℌ Å", "x" * 200,
    ):
        for _ in range(2):
            ids = np.frombuffer(own.encode(t), "<u4").tolist()
            assert ids == library.encode(t, add_special_tokens=False).ids, t


def test_two_merges_of_one_symbol_are_refused(tmp_path):
    import json

    spec = {"model": {"vocab": {c: i for i, c in enumerate(token_counts.byte_symbols())}, "merges": [["a", "bc"], ["ab", "c"]]}}
    spec["model"]["vocab"] |= {"ab": 300, "bc": 301, "abc": 302}
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_counts.Vocabulary.read(str(path), P.PATTERN)
