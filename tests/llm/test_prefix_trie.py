"""The trie of conversations against sets of prefixes in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from limelight.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
       "ends_sha256")


def slow(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            key = f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()
            own[conv].append((turn is not None, turn or 0, hashlib.md5(key).digest(), said))
    turns = {c: [t[-1] for t in sorted(own[c], key=lambda t: t[:-1])] for c in own}
    seqs = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in seqs.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        gain = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += gain
            leaves[node[:d]] += not children[node]
    return sorted((
        min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
        children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
    ) for node, convs in members.items())


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(tuple(r[c] for c in OUT) for r in prefix_trie.prefix_nodes(spark, df, **options).collect())


def conversations(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, n, longest, words, first, growth", [
    (1, 40, 4, ["a", "bb"], 4096, 8),
    (2, 120, 9, ["a", "bb", None], 6, 1),
    (3, 60, 40, ["same"], 5, 2),
])
def test_nodes_equal_sets_of_prefixes(spark, seed, n, longest, words, first, growth):
    rows = conversations(seed, n, longest, words)
    assert found(spark, rows, first=first, growth=growth) == slow(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"), (7, None, None, None), (7, 0, "user", "é" * 3000),
        (7, 0, "user", "tie"), (7, 0, "user", "tie"), (100, 5, "user", "tie"), (100, 5, "user", "a"),
        (101, 1, "user", ""), (102, 1, "", "user"), (103, 1, "user", None), (199, None, "x", "y"),
    ]
    assert found(spark, rows) == slow(rows)
    assert found(spark, []) == []


def test_turnless_conversation_ends_at_the_root(spark):
    # ids whose own turns all lie within the part that an absent block head would give
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5][:3]
    rows = [(c, 0, "user", "gone") for c in lone]
    (root,) = found(spark, rows)
    assert root == (lone[0], 0, None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, lone)).encode()).hexdigest())
    assert [root] == slow(rows)


def test_equal_conversations_by_the_hundred_and_ids_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    rows = [(100 * c, t, "user", f"t{t}") for c in range(400) for t in range(7)]
    rows += [(100 * c, 0, "user", f"own{c}") for c in range(400, 450)]
    assert found(spark, rows, first=4, growth=2) == slow(rows)


def test_other_columns_do_not_matter(spark):
    rows = conversations(4, 30, 5, ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA).select(
        "*", F.lit("x").alias("last"), F.lit(1).alias("node"), F.lit("p").alias("path.x"))
    got = sorted(tuple(r[c] for c in OUT) for r in prefix_trie.prefix_nodes(spark, df).collect())
    assert got == slow(rows)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int").select(
        "a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in df.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: (x & -x))
