"""License detection by ordered signature rules.

A text becomes its words (ASCII letters lowered, other ASCII punctuation as separators)
joined by single spaces, in UTF-8. A rule is a regular expression over that form with a
label, a priority and keywords; it runs only on texts that hold one of its keywords, which
one pass of an Aho-Corasick automaton over the text finds. Of detections that lie within
another's interval the weaker one goes: the lower priority, then the shorter, then the
later rule.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, utf8
from .license_wordings import WORDINGS

#: A-Z lowered, every ASCII character but 0-9 and a-z a space, the rest unchanged.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

#: Phrases whose every place counts, and their labels (fixed values).
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words of the normal form; ``weight`` is its certainty."""

    name: str
    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    weight: float
    base: bool = False


@dataclass(frozen=True)
class Detection:
    """A rule's match from word ``start`` up to, not including, word ``end``."""

    rule: Rule
    start: int
    end: int


GRANT = r"(?:licensed|released|distributed|available|provided|published|made available) under (?:the )?(?:terms of )?(?:the )?"


def _versions(label: str, names: Iterable[str], versions: Iterable[str], keywords: tuple[str, ...], certainty: float):
    """Rules of one license family: each name alone, by version, and in a grant."""
    for i, name in enumerate(names):
        yield Rule(f"{label}-name-{i}", label, name, keywords, 40, certainty * 0.8)
        yield Rule(f"{label}-grant-{i}", label, GRANT + name, keywords, 60, certainty)
        for v in versions:
            number = v.replace(".", " ?")
            own = f"{label}-{v}"
            tail = rf"{name},?(?: licen[cs]e)?(?: version| v| ver)? ?{number}"
            # the number must end there: 2 is not 2 0 or 2 1
            tail += r"(?! \d(?:\D|$))(?!\d)"
            yield Rule(f"{own}-name-{i}", own, tail, keywords, 70, certainty * 0.9)
            yield Rule(f"{own}-grant-{i}", own, GRANT + tail, keywords, 80, certainty)
            if v.split(".")[0] == v or v.endswith(".0"):
                yield Rule(
                    f"{own}-later-{i}", f"{own}-or-later",
                    tail + r"(?: of the licen[cs]e)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?",
                    keywords, 90, certainty,
                )


@lru_cache(maxsize=1)
def signature_rules() -> tuple[Rule, ...]:
    """All rules, in order: base phrases, license families, identifiers, single wordings."""
    rules = [
        Rule(f"base-{label}", label, phrase, (phrase,), 30, 0.7, base=True)
        for phrase, label in BASE_PHRASES
    ]
    families = (
        ("gpl", (r"gnu (?:general public licen[cs]e|gpl)", r"gpl"), ("1", "2", "3", "2.0", "3.0"), ("gnu", "gpl"), 1.0),
        ("lgpl", (r"gnu (?:lesser|library) general public licen[cs]e", r"lgpl"), ("2", "2.1", "3", "3.0"), ("gnu", "lgpl"), 1.0),
        ("agpl", (r"gnu affero general public licen[cs]e", r"agpl"), ("3", "3.0"), ("gnu", "agpl"), 1.0),
        ("gfdl", (r"gnu free documentation licen[cs]e", r"gfdl"), ("1.1", "1.2", "1.3"), ("gnu", "gfdl"), 1.0),
        ("apache", (r"apache (?:software )?licen[cs]e", r"asl"), ("1.0", "1.1", "2.0"), ("apache", "asl"), 1.0),
        ("mpl", (r"mozilla public licen[cs]e", r"mpl"), ("1.0", "1.1", "2.0"), ("mozilla", "mpl"), 1.0),
        ("epl", (r"eclipse public licen[cs]e", r"epl"), ("1.0", "2.0"), ("eclipse", "epl"), 1.0),
        ("cddl", (r"common development and distribution licen[cs]e", r"cddl"), ("1.0", "1.1"), ("common development", "cddl"), 1.0),
        ("cpl", (r"common public licen[cs]e",), ("1.0",), ("common public",), 0.9),
        ("eupl", (r"european union public licen[cs]e", r"eupl"), ("1.0", "1.1", "1.2"), ("european union", "eupl"), 1.0),
        ("osl", (r"open software licen[cs]e",), ("1.0", "2.0", "2.1", "3.0"), ("open software",), 0.9),
        ("afl", (r"academic free licen[cs]e",), ("1.1", "1.2", "2.0", "2.1", "3.0"), ("academic free",), 0.9),
        ("artistic", (r"artistic licen[cs]e",), ("1.0", "2.0"), ("artistic",), 0.9),
        ("bsl", (r"boost software licen[cs]e",), ("1.0",), ("boost software",), 1.0),
        ("ms-pl", (r"microsoft public licen[cs]e",), ("1.0",), ("microsoft public",), 0.9),
        ("python", (r"python software foundation licen[cs]e",), ("2", "2.0"), ("python software",), 0.9),
        ("php", (r"php licen[cs]e",), ("3.0", "3.01"), ("php",), 0.9),
        ("zpl", (r"zope public licen[cs]e",), ("1.1", "2.0", "2.1"), ("zope",), 0.9),
        ("ofl", (r"sil open font licen[cs]e",), ("1.0", "1.1"), ("open font",), 1.0),
        ("odbl", (r"open database licen[cs]e",), ("1.0",), ("open database",), 0.9),
        ("ecl", (r"educational community licen[cs]e",), ("1.0", "2.0"), ("educational community",), 0.9),
    )
    for label, names, versions, keywords, certainty in families:
        rules += _versions(label, names, versions, keywords, certainty)
    rights = (
        ("by", r"by", r"attribution"), ("by-sa", r"by sa", r"attribution share ?alike"),
        ("by-nc", r"by nc", r"attribution non ?commercial"),
        ("by-nd", r"by nd", r"attribution no ?deriv(?:ative)?s?(?: works)?"),
        ("by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
        ("by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    )
    for i, (kind, short, long) in enumerate(rights):
        own = f"cc-{kind}"
        only = r"(?! (?:nc|nd|sa)\b)"
        rules += [
            Rule(f"{own}-short", own, f"cc {short}{only}", ("cc by",), 50 + i, 0.8),
            Rule(f"{own}-long", own, f"creative commons {long}", ("creative commons",), 50 + i, 0.9),
            Rule(f"{own}-grant", own, f"{GRANT}(?:a )?(?:cc {short}{only}|creative commons {long})", ("cc by", "creative commons"), 65 + i, 1.0),
        ]
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            number = v.replace(".", " ?")
            rules += [
                Rule(f"{own}-{v}-short", f"{own}-{v}", f"cc {short} {number}", ("cc by",), 75 + i, 1.0),
                Rule(f"{own}-{v}-grant", f"{own}-{v}", f"{GRANT}(?:a )?cc {short} {number}", ("cc by",), 85 + i, 1.0),
                Rule(f"{own}-{v}-long", f"{own}-{v}", rf"creative commons {long}(?: licen[cs]e)?(?: version)? {number}(?: international| unported| generic)?", ("creative commons",), 75 + i, 1.0),
            ]
    rules += [
        Rule("cc0", "cc0", r"(?:cc0|cc zero|creative commons zero)(?: 1 ?0)?", ("cc0", "cc zero", "commons zero"), 70, 1.0),
        Rule("mit-grant", "mit", GRANT + r"mit(?: licen[cs]e)?\b", ("the mit", "of mit", "under mit"), 60, 1.0),
        Rule("mit-text", "mit", r"permission is hereby granted free of charge to any person obtaining a copy", ("permission is hereby granted",), 95, 1.0),
        Rule("isc-name", "isc", r"isc licen[cs]e", ("isc licen",), 50, 0.9),
        Rule("isc-text", "isc", r"permission to use copy modify and or distribute this software for any purpose", ("permission to use",), 95, 1.0),
        Rule("bsd-name", "bsd", r"(?:new |modified |simplified )?bsd(?: style)? licen[cs]e", ("bsd",), 50, 0.9),
        *[
            Rule(f"bsd-{n}", f"bsd-{n}-clause", rf"(?:bsd {n} clause|{n} clause bsd)(?: licen[cs]e)?", ("bsd",), 70, 1.0)
            for n in (0, 2, 3, 4)
        ],
        Rule("bsd-text", "bsd", r"redistribution and use in source and binary forms with or without modification", ("redistribution and use",), 95, 1.0),
        Rule("gpl-text", "gpl", r"this program is free software you can redistribute it and or modify", ("free software",), 95, 1.0),
        Rule("apache-text", "apache-2.0", r"you may not use this file except in compliance with the license", ("except in compliance",), 95, 1.0),
        Rule("unlicense", "unlicense", r"this is free and unencumbered software released into the public domain|the unlicense\b", ("unencumbered", "unlicense"), 95, 1.0),
        Rule("wtfpl", "wtfpl", r"do what the f\w+ you want to public licen[cs]e|wtfpl", ("wtfpl", "want to public"), 70, 1.0),
        Rule("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", ("zlib",), 60, 0.9),
        Rule("public-domain", "public-domain", r"(?:dedicated to|released into|in) the public domain", ("public domain",), 60, 0.7),
        Rule("proprietary", "proprietary", r"(?:proprietary and confidential|all rights (?:are )?reserved)", ("proprietary", "reserved"), 45, 0.6),
        Rule("copyright", "copyright-notice", r"copyright (?:c )?(?:19|20)\d\d", ("copyright",), 40, 0.5),
        Rule("no-redistribution", "proprietary", r"(?:may not be|no part of this \w+ may be) (?:copied|reproduced|redistributed)", ("may not be", "no part of"), 45, 0.6),
    ]
    identifiers = (
        "mit", "isc", "unlicense", "wtfpl", "zlib", "bsd-2-clause", "bsd-3-clause", "apache-1.1",
        "apache-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gpl-3.0-only", "gpl-3.0-or-later",
        "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0-only", "lgpl-3.0-or-later",
        "agpl-3.0-only", "agpl-3.0-or-later", "mpl-1.1", "mpl-2.0", "epl-1.0", "epl-2.0",
        "cc0-1.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "cc-by-nc-sa-4.0", "bsl-1.0",
    )
    rules += [
        Rule(f"spdx-{name}", name, r"spdx license identifier " + re.sub(r"[-.]", " ", name), ("spdx",), 100, 1.0)
        for name in identifiers
    ]
    rules += [
        Rule(name, label, pattern, (keyword,), priority, weight)
        for name, label, priority, weight, keyword, pattern, _ in WORDINGS
    ]
    return tuple(rules)


def _letters(body: bytes) -> str:
    """One letter per byte, as the automaton reads strings."""
    return body.decode("latin-1")


class Scanner:
    """Compiled rules behind one automaton of all keywords; an empty keyword is in every text."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.compiled = [
            (rule, re.compile(rb"(?<![^ ])(?:" + rule.pattern.encode() + rb")(?![^ ])")) for rule in rules
        ]
        self.always = {i for i, rule in enumerate(rules) if "" in rule.keywords}
        by_keyword: dict[str, set[int]] = {}
        for i, rule in enumerate(rules):
            for keyword in filter(None, rule.keywords):
                by_keyword.setdefault(_letters(keyword.encode()), set()).add(i)
        self.gate = ahocorasick.Automaton()
        for keyword, asked in by_keyword.items():
            self.gate.add_word(keyword, (keyword, asked))
        if by_keyword:
            self.gate.make_automaton()

    def asked(self, body: bytes) -> list[int]:
        """The rules that one of their keywords opens for a text in normal form."""
        opened, seen = set(self.always), set()
        if len(self.gate):
            for _, (keyword, rules) in self.gate.iter(_letters(body)):
                if keyword not in seen:
                    seen.add(keyword)
                    opened |= rules
        return sorted(opened)

    def scan(self, text: bytes) -> tuple[int, list[Detection]]:
        """Number of words, and all detections of all rules before suppression."""
        words = text.translate(WORD_BYTES).split()
        body = b" ".join(words)
        found, starts = [], None
        for i in self.asked(body):
            rule, pattern = self.compiled[i]
            at = 0
            while m := pattern.search(body, at):
                if starts is None:  # where each word begins
                    starts = list(accumulate((len(w) + 1 for w in words[:-1]), initial=0))
                first = bisect_right(starts, m.start()) - 1
                found.append(Detection(rule, first, bisect_right(starts, m.end() - 1)))
                # the next match may begin within this one, at its second word
                at = starts[first + 1] if first + 1 < len(starts) else len(body) + 1
        return len(words), found


def suppress(detections: list[Detection]) -> list[Detection]:
    """Detections that lie in the interval of none that is stronger, by place.

    Stronger: higher priority, then longer, then earlier in the rules.
    """
    ordered = sorted(
        enumerate(detections), key=lambda x: (-x[1].rule.priority, x[1].start - x[1].end, x[0])
    )
    kept: list[Detection] = []
    reach: dict[int, int] = {}  # furthest end of the kept intervals that hold a word
    for _, d in ordered:
        if reach.get(d.start, 0) < d.end:
            kept.append(d)
            for word in range(d.start, d.end):
                reach[word] = max(reach.get(word, 0), d.end)
    return sorted(kept, key=lambda d: (d.start, d.end, d.rule.name))


def scan_licenses(
    df: DataFrame, rules: tuple[Rule, ...] | None = None, text: str = "text"
) -> DataFrame:
    """``df`` with the license evidence of every whole text.

    Adds n_words, places (start words of all matches of base rules), base_labels (distinct,
    sorted), detections (rule, label, start, end, weight; what suppression leaves), labels
    (of the detections and the base phrases; distinct, sorted) and score: the largest weight
    of a detection, 0 without any. Null and empty texts have no words. Repeated rows get
    equal results; columns named like an output are replaced, others pass through; an
    empty table gives an empty result.
    """
    rules = signature_rules() if rules is None else rules
    span = T.StructType([
        T.StructField("rule", T.StringType()), T.StructField("label", T.StringType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("weight", T.DoubleType()),
    ])
    strings = T.ArrayType(T.StringType())
    outputs = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("base_labels", strings), T.StructField("detections", T.ArrayType(span)),
        T.StructField("labels", strings), T.StructField("score", T.DoubleType()),
    ])

    def factory():
        scanner = Scanner(rules)

        def one(text: bytes) -> tuple:
            n, found = scanner.scan(text)
            if not found:
                return n, [], [], [], [], 0.0
            base = [d for d in found if d.rule.base]
            kept = suppress(found)
            base_labels = {d.rule.label for d in base}
            return (
                n, sorted(d.start for d in base), sorted(base_labels),
                [
                    {"rule": d.rule.name, "label": d.rule.label, "start": d.start, "end": d.end,
                     "weight": d.rule.weight} for d in kept
                ],
                sorted(base_labels | {d.rule.label for d in kept}),
                max(d.rule.weight for d in kept),
            )

        def compute(column: pa.Array):
            made = [one(t) for t in utf8(column)]
            return [list(c) for c in zip(*made)] if made else [[] for _ in outputs]
        return compute

    return add_columns(df, [text], outputs, factory)
