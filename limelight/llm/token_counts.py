"""Token counts of a byte-level BPE by rank-synchronous merging of arrays.

The distinct pre-tokens of a batch lie in one flat array of symbols with the bounds of
each sequence beside it. In every round each sequence finds the rank of its lowest pair
and merges all places of that pair at once, until no sequence has a pair with a rank. A
merge of rank r only makes pairs of higher rank (every merge makes a symbol of its own,
which is checked when the file is read), so this is what merging one pair at a time gives.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns

#: Pre-tokens longer than this are not kept from batch to batch.
CACHED_CHARS = 48


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: symbol -> byte.

    Printable Latin-1 stands for itself, the other bytes follow from code point 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Merges as sorted arrays: key of the pair, its rank, and the symbol it makes."""

    start: np.ndarray  # symbol of each byte
    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    size: int
    specials: tuple[str, ...]
    pattern: regex.Pattern

    NONE = np.int64(1 << 40)

    @classmethod
    def read(cls, path: str, pattern: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("two merges make the same symbol; ranks are not monotonic")
        size = max(ids.values()) + 1
        start = np.zeros(256, np.int64)
        for symbol, byte in byte_symbols().items():
            start[byte] = ids[symbol]
        order = np.argsort(left * size + right)
        specials = tuple(t["content"] for t in spec.get("added_tokens", []))
        return cls(
            start, (left * size + right)[order], order.astype(np.int64), made[order], size,
            specials, regex.compile(pattern),
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NONE where there is no merge, and its place in the arrays."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.NONE), at


def count_symbols(words: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Symbols that remain of each non-empty byte sequence when no merge applies."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = lengths.copy()
    symbols = vocabulary.start[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)  # sequence of each symbol
    while len(symbols) > 1:
        rank, at = vocabulary.rank(symbols[:-1], symbols[1:])
        rank[owner[:-1] != owner[1:]] = vocabulary.NONE
        # lowest rank of each sequence; its symbols are consecutive
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        low = np.minimum.reduceat(np.r_[rank, vocabulary.NONE], first)
        spans = np.diff(np.r_[first, len(symbols)])
        lows = np.repeat(low, spans)
        hit = (rank == lows[:-1]) & (rank != vocabulary.NONE)
        # a pair of equal symbols overlaps itself: of each run, take every other place
        places = np.flatnonzero(hit)
        if len(places):
            run = np.r_[True, np.diff(places) != 1]
            place_in_run = np.arange(len(places)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            places = places[place_in_run % 2 == 0]
        symbols[places] = vocabulary.made[at[places]]
        stay = np.ones(len(symbols), bool)
        stay[places + 1] = False
        # a sequence without a merge is done and leaves
        done = lows == vocabulary.NONE
        finished = owner[first][low == vocabulary.NONE]
        counts[finished] = spans[low == vocabulary.NONE]
        stay &= ~done
        symbols, owner = symbols[stay], owner[stay]
    if len(symbols):
        counts[owner] = 1
    return counts


class TokenCounter:
    """Counts tokens of texts; remembers the counts of short pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = 400_000) -> None:
        self.vocabulary, self.remembered = vocabulary, remembered
        self.known: dict[str, int] = {}
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def pre_tokens(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens with their numbers, and the number of special tokens."""
        find = self.vocabulary.pattern.findall
        if self.split is None or not self.split.search(text):
            return Counter(find(text)), 0
        parts = self.split.split(text)
        found: Counter = Counter()
        for part in parts:
            found.update(find(part))
        return found, len(parts) - 1

    def count(self, texts: list[str | None]) -> list[int]:
        known = self.known
        found = [self.pre_tokens(t) if t else (Counter(), 0) for t in texts]
        missing = list({w for c, _ in found for w in c if w not in known})
        # arrays of a bounded number of symbols at a time
        batch: list[str] = []
        size, fresh = 0, {}
        for word in missing:
            batch.append(word)
            size += len(word)
            if size > 1 << 20:
                fresh.update(self._counts(batch))
                batch, size = [], 0
        fresh.update(self._counts(batch))
        totals = [
            n + sum(k * (known[w] if w in known else fresh[w]) for w, k in c.items())
            for c, n in found
        ]
        if len(known) > self.remembered:
            known.clear()
        known.update((w, n) for w, n in fresh.items() if len(w) <= CACHED_CHARS)
        return totals

    def _counts(self, words: list[str]) -> dict[str, int]:
        if not words:
            return {}
        encoded = [w.encode("utf-8") for w in words]
        return dict(zip(words, count_symbols(encoded, self.vocabulary).tolist()))


@lru_cache(maxsize=1)
def token_counter(path: str, pattern: str) -> TokenCounter:
    """One per Python worker, so that what it remembers serves the next task too."""
    return TokenCounter(Vocabulary.read(path, pattern))


def with_token_counts(
    df: DataFrame, path: str, pattern: str, text: str = "text", limit: int = 512
) -> DataFrame:
    """``df`` with n_bytes, n_tokens (BIGINT) and over_limit of every whole text.

    ``path`` is a tokenizer file that every executor can open; ``pattern`` cuts texts into
    pre-tokens. Special strings inside a text count as one token each. Null text counts as
    empty: no tokens, no bytes. Columns named like an output are replaced; other columns,
    nulls in them and repeated rows pass through. An empty table gives an empty result.
    """
    outputs = T.StructType([
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def factory():
        counter = token_counter(path, pattern)

        def compute(column: pa.Array):
            sizes, counts = [], []
            for start in range(0, len(column), 256):
                texts = column.slice(start, 256).to_pylist()
                sizes += [len(t.encode("utf-8")) if t else 0 for t in texts]
                counts += counter.count(texts)
            return [sizes, counts, [n > limit for n in counts]]
        return compute

    return add_columns(df, [text], outputs, factory)
