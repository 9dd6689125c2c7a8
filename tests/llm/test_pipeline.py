"""The pipeline against a chain in plain Python, and its stages on odd and empty tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from limelight.llm import quality_lines, tiling
from limelight.llm.queries import quality_labels, table

P = pytest.importorskip("public_tokenizers")
WS = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = {c: c + 32 for c in range(65, 91)}
LONG = " ".join(f"word{i}" for i in range(60_000))
ODD = [None, "", " \n\t ", "one", LONG, "same text here", "same text here", "é ñ\x00\x01 日本"]


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


def good(text, field):
    words = words_of(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeats = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    if len(words) < 50 or 100 * len(repeats) > 50 * len(words):
        return False
    features, sizes = quality_lines.line_features(text.encode())
    states = field.decode(features) if field else np.zeros(len(sizes))
    return sizes[states == quality_lines.CONTENT].sum() >= 0.5 * sizes.sum()


def without_repeated_lines(texts):
    def key(line):
        return line.strip(WS).translate(LOWER)

    first = {}
    for doc in sorted(texts):
        for line in texts[doc].split("\n"):
            first.setdefault(key(line), doc)
    return {
        doc: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == doc)
        for doc, t in texts.items()
    }


def fingerprint(text):
    words = words_of(text.translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def first_of_each_group(texts):
    docs = sorted(texts)
    prints = [fingerprint(texts[d]) for d in docs]
    seen, kept = set(), {}
    for i, doc in enumerate(docs):
        if i in seen:
            continue
        kept[doc], todo = texts[doc], [i]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += [j for j in range(len(docs)) if (prints[at] ^ prints[j]).bit_count() <= 4]
    return kept


def contaminated(text, items):
    words = re.findall(r"[^\W_]+", text.lower())
    windows = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    for item in items:
        if not any(tuple(item[i:i + 5]) in windows for i in range(len(item) - 4)):
            continue
        codes = defaultdict(lambda: len(codes) + 1)
        a, b = (np.array([codes[w] for w in x], np.uint64) for x in (words, item))
        if sum(n for _, _, n in tiling.tiles(a, b, 5)) >= 0.8 * len(item):
            return True
    return False


def test_every_stage_equals_plain_python(spark, data_dir):
    from tokenizers import Tokenizer

    frame = pd.read_parquet(f"{data_dir}/documents.parquet")
    texts = {d: t or "" for d, t in zip(frame["doc_id"].tolist(), frame["text"].tolist())}
    items = [
        w for t in pd.read_parquet(f"{data_dir}/benchmark.parquet")["text"]
        if len(w := re.findall(r"[^\W_]+", (t or "").lower())) >= 5
    ]
    field = quality_lines.train(table(spark, data_dir, "documents"), quality_labels(spark, data_dir))
    texts = {d: t for d, t in texts.items() if good(t, field)}
    sizes = [len(texts)]
    texts = without_repeated_lines(texts)
    sizes.append(len(texts))
    texts = first_of_each_group(texts)
    sizes.append(len(texts))
    texts = {d: t for d, t in texts.items() if not contaminated(t, items)}
    sizes.append(len(texts))
    assert frame.shape[0] > sizes[0] == sizes[1] > sizes[2] > sizes[3] > 0  # each stage does something

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, data_dir).collect():
        pieces[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert pieces.keys() == texts.keys()
    for doc, text in texts.items():
        made = sum((ids for _, ids in sorted(pieces[doc])), [])
        assert made == tokenizer.encode(text, add_special_tokens=False).ids + [2], doc


@pytest.fixture
def odd(spark):
    """Odd texts, a null id, a repeated row, and columns named like what operators add."""
    pairs = [*enumerate(ODD), (None, "no id"), (3, "one")]
    made = spark.createDataFrame(
        [(i, t, "en", None, 0) for i, t in pairs],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    for name in ("kept", "n_words", "n_lines", "N_DROPPED", "fingerprint", "hits", "ids", "a.b"):
        made = made.withColumn(name, F.lit("mine"))
    return made


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows_and_empty_tables(spark, odd, data_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, odd.limit(0), data_dir).count() == 0
    made = stage(spark, odd, data_dir)
    rows = made.collect()
    if name == "packing":
        assert {r["doc_id"] for r in rows} == {None, *range(len(ODD))}
        return
    assert made.columns == odd.columns
    assert {r[c] for r in rows for c in odd.columns[5:]} <= {"mine"}
    found = Counter((r["doc_id"], r["text"]) for r in rows)
    whole = Counter([*enumerate(ODD), (None, "no id"), (3, "one")])
    if name == "quality_rules":
        assert set(found) <= {(4, LONG)}
    elif name == "line_dedup":
        assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(str(d) for d, _ in whole.elements())
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
        texts = {r["doc_id"]: r["text"] for r in rows}
        assert texts[4] == LONG and texts[5] == "same text here" and texts[6] == ""
    elif name == "simhash_dedup":
        assert sorted(map(str, (r["doc_id"] for r in rows))) == ["0", "3", "4", "5", "7", "None"]
    else:
        assert found == whole
