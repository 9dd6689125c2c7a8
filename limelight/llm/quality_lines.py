"""Line labels by a linear-chain conditional random field, and documents judged by them.

Every line with a word is a position of the chain; its states are content and
boilerplate. Viterbi decoding finds the best labels, and the share of a document's words
in content lines decides whether it is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, labelled_sample, map_batches, utf8

SYMBOLS = b"#*$%&|<>"
ENDS = (b".", b"!", b"?", b":", b'"')
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
NOTICES = (
    b"licens", b"copyright", b"rights reserved", b"cookie", b"privacy", b"terms of", b"subscribe",
    b"http://", b"https://", b"click here", b"sign up", b"log in",
)
CONTENT, BOILERPLATE = 0, 1
N_FEATURES = 15


# --- facts of whole texts --------------------------------------------------------------


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that are found twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(table) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(
        pairs[:-1] * len(table) + ids[2:], return_inverse=True, return_counts=True
    )
    often = counts[windows] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= often
    return int(covered.sum())


def facts(text: str, body: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    lines = [line for line in body.split(b"\n") if line.strip()]
    return chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


# --- features --------------------------------------------------------------------------


def line_features(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """One row of features, and the number of words, of each line with a word."""
    rows, sizes, seen = [], [], set()
    lines = [line for line in body.split(b"\n") if line.strip()]
    for line in lines:
        words = line.split()
        n, length = len(words), len(line)
        distinct = len(set(words))
        adjacent = sum(map(bytes.__eq__, words, words[1:]))
        letters_up = length - len(line.translate(None, UPPER))
        symbols = length - len(line.translate(None, SYMBOLS))
        rows.append((
            1.0,
            math.log1p(n) / 5,
            min(1.0, n / 40),
            symbols / n if symbols < n else 1.0,
            min(1.0, 2 * symbols / length),
            letters_up / length,
            (length - len(line.translate(None, DIGITS))) / length,
            distinct / n,
            adjacent / n,
            1.0 if line.rstrip().endswith(ENDS) else 0.0,
            min(1.0, line.count(b"|") / n),
            min(1.0, line.count(b"!") / n),
            min(1.0, length / n / 20),
            1.0 if line in seen else 0.0,
            1.0 if any(map(line.lower().__contains__, NOTICES)) else 0.0,
        ))
        sizes.append(n)
        seen.add(line)
    return np.array(rows, float).reshape(-1, N_FEATURES), np.array(sizes, np.int64)


# --- the field -------------------------------------------------------------------------


@dataclass
class Field:
    """Weights of the features for boilerplate against content, and of the transitions."""

    weights: np.ndarray  # N_FEATURES
    moves: np.ndarray  # 2 x 2, from state to state

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: the most likely states; content on ties."""
        n = len(features)
        if not n:
            return np.empty(0, np.int64)
        gains = (features @ self.weights).tolist()
        (cc, cb), (bc, bb) = self.moves.tolist()
        content, boiler = 0.0, gains[0]
        back = []
        for gain in gains[1:]:
            from_c = content + cb > boiler + bb if content + cb != boiler + bb else True
            stay_c = content + cc >= boiler + bc
            content, boiler = (
                content + cc if stay_c else boiler + bc,
                (content + cb if from_c else boiler + bb) + gain,
            )
            back.append((CONTENT if stay_c else BOILERPLATE, CONTENT if from_c else BOILERPLATE))
        state = BOILERPLATE if boiler > content else CONTENT
        states = [state]
        for previous in reversed(back):
            state = previous[state]
            states.append(state)
        return np.array(states[::-1])


def _chains(documents: list[tuple[np.ndarray, np.ndarray]], length: int):
    """Documents cut into chains of at most ``length`` lines, padded: x, y, mask."""
    parts = [
        (x[s:s + length], y[s:s + length]) for x, y in documents for s in range(0, len(x), length)
    ]
    xs = np.zeros((len(parts), length, N_FEATURES))
    ys = np.zeros((len(parts), length), np.int64)
    mask = np.zeros((len(parts), length), bool)
    for i, (x, y) in enumerate(parts):
        xs[i, :len(x)], ys[i, :len(x)], mask[i, :len(x)] = x, y, True
    return xs, ys, mask


def _expected(unary: np.ndarray, moves: np.ndarray, mask: np.ndarray):
    """Forward-backward: boilerplate probabilities and expected transition counts."""
    n, length = unary.shape
    scores = np.zeros((n, length, 2))
    scores[:, :, 1] = unary
    forward = np.zeros((n, length, 2))
    forward[:, 0] = scores[:, 0]
    for t in range(1, length):
        step = np.logaddexp(forward[:, t - 1, :1] + moves[0], forward[:, t - 1, 1:] + moves[1])
        forward[:, t] = np.where(mask[:, t, None], step + scores[:, t], forward[:, t - 1])
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    backward = np.zeros((n, length, 2))
    counts = np.zeros((2, 2))
    for t in range(length - 2, -1, -1):
        ahead = scores[:, t + 1] + backward[:, t + 1]
        live = mask[:, t + 1]
        joint = forward[:, t, :, None] + moves + ahead[:, None, :] - total[:, None, None]
        counts += np.exp(joint[live]).sum(axis=0)
        step = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        backward[:, t] = np.where(live[:, None], step, backward[:, t + 1])
    shares = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
    return shares, counts, total


def fit(
    documents: list[tuple[np.ndarray, np.ndarray]], steps: int = 200, rate: float = 1.0,
    ridge: float = 1e-5, length: int = 32,
) -> Field | None:
    """Maximum likelihood of the labelled lines by ever smaller gradient steps (Adam)."""
    if not documents or not any((y == BOILERPLATE).any() for _, y in documents):
        return None
    x, y, mask = _chains(documents, length)
    lines = mask.sum()
    seen = (x * (y * mask)[:, :, None]).sum(axis=(0, 1))
    pairs = np.zeros((2, 2))
    live = mask[:, 1:]
    np.add.at(pairs, (y[:, :-1][live], y[:, 1:][live]), 1)
    theta = np.zeros(N_FEATURES + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        moves = theta[N_FEATURES:].reshape(2, 2)
        shares, counts, _ = _expected(x @ theta[:N_FEATURES], moves, mask)
        expected = (x * (shares * mask)[:, :, None]).sum(axis=(0, 1))
        gradient = np.r_[seen - expected, (pairs - counts).ravel()] / lines - ridge * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        theta = theta + rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.99 ** step)) + 1e-8
        )
    return Field(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))


def shared_lines(documents: list[np.ndarray], contexts: int) -> np.ndarray:
    """Hashes of lines found between at least ``contexts`` different pairs of neighbours."""
    places = []
    for keys in documents:
        around = np.r_[np.uint64(0), keys, np.uint64(0)]
        places.append(np.stack([keys, around[:-2] * np.uint64(31) + around[2:]], axis=1))
    hashes, counts = np.unique(
        np.unique(np.concatenate(places), axis=0)[:, 0], return_counts=True
    )
    return hashes[counts >= contexts]


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label",
    id_col: str = "doc_id", documents: int = 2000, lines: int = 400, shared: int = 5,
) -> Field | None:
    """Fit the field on at most ``documents`` labelled documents (smallest hashes of ids).

    Lines of documents labelled 1 are content, those of documents labelled 0 and lines found
    between at least ``shared`` different pairs of neighbours (so not lines of copies) are
    boilerplate. Features are computed by the executors; at most ``lines`` consecutive lines
    of a document, from a place its hash gives, come to the driver. None without documents
    of both labels: then every line is content.
    """
    rows = labelled_sample(docs, labels, documents, text=text, label=label, id_col=id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, xs, keys = [], [], []
            for value, body in zip(batch.column(2).to_pylist(), utf8(batch.column(1))):
                x, _ = line_features(body)
                if not len(x):
                    continue
                own = [line for line in body.split(b"\n") if line.strip()]
                start = xxhash.xxh64_intdigest(body) % max(1, len(x) - lines + 1)
                part = slice(start, start + lines)
                labels.append(value)
                xs.append(x[part].astype("<f4").tobytes())
                keys.append(b"".join(xxhash.xxh64_digest(line) for line in own[part]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(xs, pa.binary()), pa.array(keys, pa.binary())],
                names=["label", "x", "keys"],
            )

    found = map_batches(rows, run, "label int, x binary, keys binary").collect()
    if {r["label"] for r in found} != {0, 1}:
        return None
    keys = [np.frombuffer(r["keys"], ">u8").astype(np.uint64) for r in found]
    common = shared_lines(keys, shared)
    chains = []
    for row, key in zip(found, keys):
        x = np.frombuffer(row["x"], "<f4").astype(float).reshape(-1, N_FEATURES)
        y = np.full(len(x), BOILERPLATE if row["label"] == 0 else CONTENT)
        y[np.isin(key, common)] = BOILERPLATE
        chains.append((x, y))
    return fit(chains)


def judge(
    df: DataFrame, field: Field | None, text: str = "text", min_share: float = 0.5,
    min_words: int = 50, max_repeats: int = 50,
) -> DataFrame:
    """``df`` with the facts of every whole text and the verdict on it.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under
    ``min_words`` words, or more than ``max_repeats`` percent of them in repeated windows),
    n_lines (with a word), n_content_lines, content_share (of words, null without words) and
    kept (base passed and a content share of at least ``min_share``).

    Null and empty texts have no words and fail. Without a field every line is content.
    Repeated rows get equal verdicts; columns named like an output are replaced, others
    pass through; an empty table gives an empty result.
    """
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    outputs = T.StructType([
        *[T.StructField(n, T.LongType()) for n in longs],
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_content_lines", T.LongType()),
        T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    ])

    def one(value: str | None) -> tuple:
        whole = value or ""
        body = whole.encode("utf-8")
        words = body.split()
        chars, symbols, doubles, repeats = facts(whole, body, words)
        failed = len(words) < min_words or 100 * repeats > max_repeats * len(words)
        x, sizes = line_features(body)
        states = field.decode(x) if field else np.zeros(len(x), np.int64)
        content = states == CONTENT
        share = float(sizes[content].sum() / sizes.sum()) if len(sizes) else None
        kept = not failed and share is not None and share >= min_share
        return (
            len(words), chars, symbols, doubles, repeats, failed, len(x), int(content.sum()),
            share, kept,
        )

    def factory():
        def compute(column: pa.Array):
            made = [one(v.as_py()) for v in column]
            return [list(c) for c in zip(*made)] if made else [[] for _ in outputs]
        return compute

    return add_columns(df, [text], outputs, factory)
