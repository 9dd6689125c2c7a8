"""Handle extraction, name words and matching, against plain Python."""

from __future__ import annotations

import random
import re
import string

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import values
from limelight.functions import text


def python_handles(value: str) -> list[str]:
    """The extraction rules stated with Python's own engine, in pattern and text order."""
    found = re.findall(r"instagram\.com/([a-zA-Z0-9_.]+)", value, re.IGNORECASE)
    found += [h for h in re.findall(r"(?<![@\w])@([a-zA-Z0-9_.]+)(?![@\w])", value)
              if "." not in h]
    found += re.findall(r"(?:instagram|ig)[\s:]+([a-zA-Z0-9_.]+)", value, re.IGNORECASE)
    return list(dict.fromkeys(h.lower() for h in found if len(h) > 1))


def spark_handles(spark, values_):
    df = spark.createDataFrame(list(enumerate(values_)), "i INT, t STRING")
    out = df.select("i", text.extract_handles(F.col("t")).alias("h")).collect()
    return [r.h for r in sorted(out, key=lambda r: r.i)]


@pytest.mark.parametrize("value, expected", [
    ("x instagram.com/Foo_1?y", ["foo_1"]),
    ("a@b.com", []),
    ("hi @foo", ["foo"]),
    ("@bar.", []),
    ("IG: zed", ["zed"]),
    ("big deal", ["deal"]),
    ("@é", []),
    ("@zedé @ok", ["ok"]),
    ("@@no @yes", ["yes"]),
    ("@foo.bar@x", ["foo"]),
    ("Instagram.com/a.b/ @a.b IG: c_d", ["a.b", "c_d"]),
    ("@x", []),
    ("", []),
    (None, []),
])
def test_handle_corpus(spark, value, expected):
    got = spark_handles(spark, [value])[0]
    assert got == (python_handles(value) if value else [])
    assert got == expected


def test_handles_equal_python_on_generated_texts(spark):
    rng = random.Random(11)
    pieces = ["@", "ig", "IG", "instagram", "instagram.com/", ":", " ", "\n", "\t", ".", "_", "é",
              "ß", "日", "foo", "Bar", "9", "-", "/", "?", " ", " ", "\x1c", "\x85", "b"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    got = spark_handles(spark, texts)
    wrong = [(t, g, python_handles(t)) for t, g in zip(texts, got) if g != python_handles(t)]
    assert not wrong, wrong[:5]


def test_handles_of_a_very_long_text(spark):
    value = "@" + "a" * 300_000 + "é " + "word " * 100_000 + "@last"
    assert spark_handles(spark, [value]) == [["last"]]


def test_name_variants(spark, rows):
    df = rows("n STRING", ("The X-Y. Z",)).select(text.name_handle_variants(F.col("n")).alias("v"))
    assert df.first().v == ["thexyz", "xyz", "thexyzmusic", "thexyzofficial"]


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=string.ascii_letters + " .-\t é", max_size=20))
def test_name_variants_and_words_equal_python(spark, name):
    base = name.lower().replace(" ", "").replace(".", "").replace("-", "")
    words = [w for w in name.lower().split() if w not in ("the", "a", "an", "and") and len(w) > 2]
    row = spark.createDataFrame([(name,)], "n STRING").select(
        text.name_handle_variants(F.col("n")), text.channel_name_words(F.col("n"))).first()
    assert row[0] == [base, base.replace("the", ""), base + "music", base + "official"]
    assert row[1] == words


def test_stop_lists_differ(spark, rows):
    df = rows("n STRING", ("The Ands or Them and Orr",))
    row = df.select(text.profile_name_words(F.col("n")), text.channel_name_words(F.col("n"))).first()
    assert row[0] == ["ands", "them", "orr"] and row[1] == ["ands", "them", "orr"]
    assert text.PROFILE_STOP_WORDS != text.CHANNEL_STOP_WORDS


def test_profile_matches(spark, rows):
    df = rows(
        "i INT, n STRING, f STRING, b STRING",
        (0, "Blue Ox", "the BLUE one", None),      # name word in the profile name
        (1, "Blue Ox", None, "feeling blue"),      # name word in the biography
        (2, "Ox", "ox ox", "ox"),                  # words of two letters never match
        (3, "Ox", "Husband", None),                # keyword inside a word
        (4, "Ox", None, None),
        (5, "Ox", "mus", "ic"),                    # not across the two texts
    )
    got = df.orderBy("i").select(
        text.profile_matches(F.col("n"), F.col("f"), F.col("b"))).collect()
    assert [r[0] for r in got] == [True, True, False, True, False, False]


def test_channel_match_score(spark, rows):
    df = rows(
        "i INT, n STRING, t STRING, d STRING, s BIGINT",
        (0, "Bjork", "bjork official", None, 1000),
        (1, "Bjork", "Other", "all about BJORK", 499),
        (2, "The And", "the and", "the and", 500001),
    )
    got = df.orderBy("i").select(text.channel_match_score(
        text.channel_name_words(F.col("n")), F.col("t"), F.col("d"), F.col("s"))).collect()
    assert [r[0] for r in got] == [16, 2, 0]


@pytest.mark.parametrize("title, caption, expected", [
    ("red ox", "the red door", False),
    ("blue bolt", "a blue car", True),
    ("Red Ox", "my RED OX song", True),
    ("four", None, False),
    ("", None, True),
])
def test_caption_mentions_track(spark, rows, title, caption, expected):
    df = rows("t STRING, c STRING", (title, caption))
    assert df.select(text.caption_mentions_track(F.col("c"), F.col("t"))).first()[0] is expected


def test_published_date(spark, rows):
    cases = {
        "2024-03-01T23:30:00Z": "2024-03-01", "2024-03-01T23:30:00+05:00": "2024-03-01",
        "2024-02-30T00:00:00Z": None, "soon": None, "": None, "2024": None,
        "2024-03-01": "2024-03-01",
    }
    df = rows("p STRING", *[(c,) for c in cases], (None,))
    got = {r[0]: r[1] and str(r[1]) for r in df.select(
        "p", text.published_date(F.col("p"))).collect()}
    assert got == {**cases, None: None}


def test_links_and_excerpt(spark, rows):
    df = rows("c STRING, s STRING", ("x" * 300, "abc"), (None, "d"))
    got = values(df.select(F.length(text.caption_excerpt(F.col("c"))).alias("n"),
                           text.post_url(F.col("s")).alias("u"),
                           text.video_url(F.col("s")).alias("v")))
    assert got == [(0, "https://www.instagram.com/p/d/", "https://www.youtube.com/watch?v=d"),
                   (200, "https://www.instagram.com/p/abc/",
                    "https://www.youtube.com/watch?v=abc")]


def test_handle_clean(spark, rows):
    df = rows("h STRING", ("@a@b",), (None,))
    assert values(df.select(text.handle_clean(F.col("h")).alias("x"))) == sorted(
        ["ab", None], key=str)
