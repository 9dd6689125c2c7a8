"""Hierarchical packing of tokenised documents into windows of several lengths.

A document of a full window or more fills windows of its own; what is left is routed to
the smallest tier that holds it. Windows are closed from the longest tier down: a piece
opens a window of its tier, and the gap is filled with the longest pieces of shorter tiers
that fit. Where none fits, a piece is cut if both its parts stay of a stated length, and its
rest is routed anew; else a window grows to the next tier, and one of the longest tier is
closed a few places short, the only ones that are padded. What remains at the end is cut
into windows of powers of two.

Packing is local to a task and streams: about ``buffer`` tokens are held, no shuffle.
"""

from __future__ import annotations

import heapq
import json
import os
import struct
import unicodedata
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import map_batches, quoted
from .token_counts import byte_symbols

WIDTH = 4  # bytes of an id


class WordTokenizer:
    """Ids of texts as little-endian 32-bit unsigned numbers.

    For tokenizer files that normalise (NFC, lower case), drop white space and never join
    across it. The words between spaces and line feeds are looked up; those not seen lately
    are cut by the file's own pattern and given to its merges. Two generations of up to
    ``remembered`` parts each are kept.
    """

    def __init__(self, path: str, remembered: int = 600_000, cached_chars: int = 48) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        cuts = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} is not a word tokenizer of the known form")
        self.pattern = regex.compile(cuts[0]["pattern"]["Regex"])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        # the merges alone, for parts that are normalised and cut already
        self.merges = Tokenizer(self.tokenizer.model)
        self.byte_names = {byte: symbol for symbol, byte in byte_symbols().items()}
        self.remembered, self.cached_chars = remembered, cached_chars
        self.known, self.older = _Known(self._word), {}

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):  # one id each, found before all else
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        # lowered letter by letter: a final sigma is no special case
        plain = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        ids = b"".join(map(self.known.__getitem__, plain.replace("\n", " ").split(" ")))
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, _Known(self._word)
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha():
                ids = self._part(word)
            else:
                ids = b"".join(map(self._part, self.pattern.findall(word)))
        if len(word) <= self.cached_chars:
            self.known[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        ids = dict.get(self.known, part) or self.older.get(part)
        if ids is None:
            plain = part.isascii() and part.isprintable()
            names = part if plain else part.encode("utf-8").decode("latin-1").translate(self.byte_names)
            ids = _packed(self.merges.encode(names, add_special_tokens=False).ids)
            if len(part) <= self.cached_chars:
                self.known[part] = ids
        return ids


class _Known(dict):
    """Ids of words, asking ``find`` for those that are missing."""

    def __init__(self, find) -> None:
        self.find = find
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that what it remembers serves the next task too."""
    return WordTokenizer(path)


@dataclass
class Piece:
    """A stretch of one document's ids."""

    doc: int  # place of the document among those of the task
    start: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // WIDTH

    def cut(self, size: int) -> tuple["Piece", "Piece"]:
        head, rest = self.ids[:size * WIDTH], self.ids[size * WIDTH:]
        return Piece(self.doc, self.start, head), Piece(self.doc, self.start + size, rest)


class TierPacker:
    """Packs pieces into windows of the tiers' lengths.

    Pieces are cut only into parts of at least ``least`` ids, a 64th of the longest tier, but
    for the last windows; windows of the longest tier may stay as many places short.
    """

    def __init__(self, tiers: tuple[int, ...]) -> None:
        if any(t & (t - 1) for t in tiers):
            raise ValueError("tiers are powers of two")
        self.tiers = tuple(sorted(tiers))
        self.longest = self.tiers[-1]
        self.least = max(1, self.longest // 64)
        self.waiting: list[tuple[int, int]] = []  # (length, number), sorted
        self.pieces: dict[int, Piece] = {}
        self.number = 0
        self.tokens = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Route a piece; full windows of a long document come out at once."""
        while len(piece) >= self.longest:
            head, piece = piece.cut(self.longest)
            yield [head]
        if len(piece):
            self._wait(piece)

    def _wait(self, piece: Piece) -> None:
        insort(self.waiting, (len(piece), self.number))
        self.pieces[self.number] = piece
        self.number += 1
        self.tokens += len(piece)

    def _take(self, place: int) -> Piece:
        size, number = self.waiting.pop(place)
        self.tokens -= size
        return self.pieces.pop(number)

    def _tier(self, size: int) -> int:
        return self.tiers[bisect_left(self.tiers, size)]

    def _part(self, gap: int) -> Piece | None:
        """What a window with this gap gets next: the longest piece that fits, or a cut one."""
        place = bisect_right(self.waiting, (gap, self.number)) - 1
        if place >= 0:
            return self._take(place)
        if gap < self.least:
            return None
        place = bisect_left(self.waiting, (gap + self.least, -1))
        if place == len(self.waiting):  # none leaves enough: take less than the gap
            place -= 1
            gap = self.waiting[place][0] - self.least
        if gap < self.least:
            return None
        part, rest = self._take(place).cut(gap)
        self._wait(rest)
        return part

    def drain(self, leave: int = 0) -> Iterator[list[Piece]]:
        """Close windows until at most ``leave`` tokens, or less than a window, wait."""
        while self.waiting and self.tokens > leave:
            tier = self._tier(self.waiting[-1][0])
            if self.tokens < tier:
                break
            window = [self._take(len(self.waiting) - 1)]
            gap = tier - len(window[0])
            while gap and self.waiting:
                part = self._part(gap)
                if part is not None:
                    window.append(part)
                    gap -= len(part)
                elif tier < self.longest:
                    gap -= tier
                    tier = self._tier(tier + 1)
                    gap += tier
                else:
                    break
            if gap and not self.waiting:  # too little is left for this window
                for piece in window:
                    self._wait(piece)
                return
            yield window

    def finish(self) -> Iterator[list[Piece]]:
        """All that waits: full windows, then windows of ever smaller powers of two."""
        yield from self.drain()
        while self.waiting:
            size = 1 << (self.tokens.bit_length() - 1)
            window, gap = [], size
            while gap:
                piece = self._take(len(self.waiting) - 1)
                if len(piece) > gap:
                    piece, rest = piece.cut(gap)
                    self._wait(rest)
                window.append(piece)
                gap -= len(piece)
            yield window


def balanced(sizes: list[int], step_tokens: int) -> list[int]:
    """Step of each window: as even in tokens as longest-first placing makes them."""
    total = sum(sizes)
    steps = max(1, -(-total // step_tokens))
    load = [(0, s) for s in range(steps)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        tokens, step = heapq.heappop(load)
        out[i] = step
        heapq.heappush(load, (tokens + sizes[i], step))
    return out


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 2, tiers: tuple[int, ...] = (256, 512, 1024, 2048, 4096),
    buffer: int = 1 << 20, step_tokens: int = 1 << 16,
) -> DataFrame:
    """One row per piece: where a stretch of a document's ids lies in which window.

    Columns: ``id_col`` as in the input, start and length (the stretch in its document),
    ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, sequence_length
    (a tier, or a smaller power of two for the last windows of a task; one of the longest
    tier may hold fewer ids and is padded), step_group (windows that are trained on together;
    about ``step_tokens`` tokens each).

    Every document's ids end in ``end_id``, so a null or empty text is that id alone. Null
    ids are carried; repeated rows are packed as often as they occur; other columns are
    not read. An empty table gives no rows. Very long documents fill windows of their own
    and are cut between them. ``path`` is a tokenizer file every executor can open.

    Sequence and step numbers hold the number of the input partition, so they are unique
    and a task that runs again makes the same ones from the same rows.
    """
    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    schema = T.StructType([
        T.StructField(id_col, source.schema["id"].dataType),
        *[T.StructField(n, T.LongType()) for n in ("start", "length")],
        T.StructField("ids", T.BinaryType()),
        *[T.StructField(n, T.LongType()) for n in (
            "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")],
    ])
    ending = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = word_tokenizer(path), TierPacker(tiers)
        base = TaskContext.get().partitionId() << 40
        ids: dict[int, object] = {}  # documents with pieces that wait
        totals: dict[int, int] = {}
        seen = sequences = steps = 0
        kind = None

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences, steps
            tokens = [sum(map(len, w)) for w in windows]
            # what is no power of two is padded to the longest tier
            sizes = [packer.longest if n & (n - 1) else n for n in tokens]
            groups = balanced(sizes, step_tokens)
            out: list[list] = [[] for _ in range(9)]
            for window, size, group in zip(windows, sizes, groups):
                offset = 0
                for piece in window:
                    row = (
                        ids[piece.doc], piece.start, len(piece), piece.ids, totals[piece.doc],
                        base + sequences, offset, size, base + steps + group,
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                    offset += len(piece)
                sequences += 1
            steps += max(groups) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], kind), *[pa.array(c) for c in out[1:3]], pa.array(out[3], pa.binary()),
                 *[pa.array(c, pa.int64()) for c in out[4:]]],
                names=schema.names,
            )

        def waiting_docs() -> None:
            held = {p.doc for p in packer.pieces.values()}
            for table in (ids, totals):
                for doc in [d for d in table if d not in held]:
                    del table[doc]

        windows: list[list[Piece]] = []
        ready = 0
        for batch in batches:
            kind = batch.schema.types[0]
            for first in range(0, len(batch), 64):
                part = batch.slice(first, 64)
                names = part.column(0).to_pylist()
                texts = [t or "" for t in part.column(1).to_pylist()]
                for name, text in zip(names, texts):
                    made = tokenizer.encode(text) + ending
                    ids[seen], totals[seen] = name, len(made) // WIDTH
                    for window in packer.add(Piece(seen, 0, made)):
                        windows.append(window)
                        ready += packer.longest
                        if ready >= buffer:
                            yield rows(windows)
                            windows, ready = [], 0
                    seen += 1
                if packer.tokens >= buffer:
                    windows += packer.drain(leave=buffer // 4)
                    yield rows(windows)
                    windows, ready = [], 0
                    waiting_docs()
        windows += packer.finish()
        if windows:
            yield rows(windows)

    return map_batches(source, run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed windows themselves: sequence_id, step_group and the ids of all pieces.

    A window has at most its tier's ids, so the pieces gathered per key are bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        pieces.groupBy("sequence_id", "step_group", "sequence_length").agg(ordered.alias("p"))
        .select(
            "sequence_id", "step_group", "sequence_length",
            F.aggregate("p", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
        )
    )
