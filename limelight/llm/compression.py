"""A quality classifier of compressed sizes.

Zstandard dictionaries are trained in pairs, from pieces of good and of bad labelled texts: as
many pieces of either, so that both are of one kind and size. A text like the good ones
compresses better with the first of a pair. The difference of its two sizes, divided by the
larger, goes through a logistic calibration fitted on labelled texts; nothing else does.
The labelled texts are halved, each half trains a pair, and the calibration sees every text
with the pair that did not; new texts are compressed with both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import add_columns, labelled_ids, labelled_sample, map_batches, quoted, utf8

PIECE = 512  # bytes: a dictionary helps most at the start of what is compressed
LEVEL = 1


@dataclass
class Model:
    """Pairs of dictionaries (good, bad), and the weights of the calibration (bias first)."""

    pairs: tuple[tuple[bytes, bytes], ...]
    weights: tuple[float, float]
    centre: float
    scale: float


class Sizes:
    """Compressed sizes of a text with good and with bad dictionaries."""

    def __init__(self, pairs: tuple[tuple[bytes, bytes], ...]) -> None:
        self.each = []
        for pair in pairs:
            for kind, data in enumerate(pair):
                shared = zstandard.ZstdCompressionDict(data)
                shared.precompute_compress(level=LEVEL)
                self.each.append((kind, zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False
                )))

    def __call__(self, text: bytes) -> tuple[int, int]:
        """Sums over all pieces of the whole text and all pairs."""
        totals = [0, 0]
        for start in range(0, len(text), PIECE):
            piece = text[start:start + PIECE]
            for kind, c in self.each:
                totals[kind] += len(c.compress(piece))
        return tuple(totals)


def difference(text: bytes, sizes: Sizes) -> float:
    """How much larger the text is with bad dictionaries, of the larger size; 0 if empty."""
    if not text:
        return 0.0
    good, bad = sizes(text)
    return (bad - good) / max(good, bad)


def pieces_of(df: DataFrame) -> DataFrame:
    """(id, half, label, place, piece) for every ``PIECE`` bytes of every whole text.

    A piece that a text repeats comes once, so no text of repetitions fills a dictionary.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, places, parts = [], [], []
            for i, body in enumerate(utf8(batch.column(3))):
                first = {}
                for start in range(0, len(body), PIECE):
                    first.setdefault(body[start:start + PIECE], start)
                row += [i] * len(first)
                places += first.values()
                parts += first
            taken = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(places, pa.int64()), pa.array(parts, pa.binary())],
                names=["id", "half", "label", "place", "piece"],
            )

    rows = df.select("id", "half", "label", "text")
    return map_batches(
        rows, run, f"id {rows.schema['id'].dataType.simpleString()}, half int, label int, place bigint, piece binary"
    )


def train_dictionaries(good: list[bytes], bad: list[bytes], size: int) -> tuple[bytes, bytes] | None:
    """Two dictionaries trained from equally many pieces, the first ones of either list.

    They are of ``size`` bytes, or a quarter of the smaller class's pieces if that is less,
    and equally long. None where the smaller class has too little text to train from.
    """
    n = min(len(good), len(bad))
    classes = good[:n], bad[:n]
    size = min(size, min(sum(map(len, c)) for c in classes) // 4)
    try:
        made = [zstandard.train_dictionary(size, c, k=64, d=8).as_bytes() for c in classes]
        while len(made[0]) != len(made[1]):  # the trainer may use less than it is given
            size = min(map(len, made))
            made = [zstandard.train_dictionary(size, c, k=64, d=8).as_bytes() for c in classes]
    except zstandard.ZstdError:
        return None
    return made[0], made[1]


def logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40,
    counts: np.ndarray | None = None,
) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; x has a column of ones.

    ``counts`` says how many rows each row stands for; one by default.
    """
    share = np.ones(len(y)) if counts is None else counts
    share = share / share.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label",
    id_col: str = "doc_id", documents: int = 3000, pieces: int = 8000,
    dictionary_bytes: int = 112 << 10,
) -> Model | None:
    """Fit on a bounded sample of labelled rows; None if a class is missing in either half,
    or has too little text for a dictionary (a few pieces of ``PIECE`` bytes).

    At most ``documents`` of either label are used, those with the smallest hashes of their
    ids, halved by another hash. ``pieces`` bounds the pieces of each half and class that a
    dictionary is built from: those whose id and place have the smallest hashes, so they
    come from all over the texts. The sample is the same in every run.

    The calibration counts each sampled text as the documents of its label that it stands
    for, so scores keep to the labels' true shares when only one of them is cut to
    ``documents``, or both are.
    """
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).cast("int")
    rows = labelled_sample(docs, labels, documents, True, text, label, id_col).withColumn("half", half)
    cut = pieces_of(rows)
    order = F.xxhash64("id", "place")
    pairs = []
    for number in (0, 1):
        samples = {}
        for value in (0, 1):
            picked = (
                cut.where((F.col("half") == number) & (F.col("label") == value))
                .orderBy(order, "id", "place").limit(pieces).select("piece").collect()
            )
            samples[value] = [bytes(r["piece"]) for r in picked]
        made = train_dictionaries(samples[1], samples[0], dictionary_bytes)
        if made is None:
            return None
        pairs.append(made)
    seen = []  # two numbers of each sampled text
    for number, pair in enumerate(pairs):
        others = rows.where(F.col("half") != number)
        seen += with_difference(others, (pair,)).select(
            F.col("label").alias("y"), "__difference"
        ).orderBy("id", "__difference").collect()
    known = labelled_ids(docs, labels, text, label, id_col).groupBy("label").count().collect()
    stands_for = {r["label"]: max(1.0, r["count"] / documents) for r in known}
    raw = np.array([r["__difference"] for r in seen])
    y = np.array([r["y"] for r in seen], float)
    return Model(tuple(pairs), *calibrated(raw, y, np.array([stands_for[r["y"]] for r in seen])))


def calibrated(
    raw: np.ndarray, y: np.ndarray, counts: np.ndarray
) -> tuple[tuple[float, float], float, float]:
    """(bias and weight, centre, scale) of a logistic regression on one number."""
    centre = float(np.average(raw, weights=counts))
    scale = float(np.sqrt(np.average((raw - centre) ** 2, weights=counts))) or 1.0
    x = np.c_[np.ones(len(y)), (raw - centre) / scale]
    bias, weight = logistic(x, y, counts=counts)
    return (float(bias), float(weight)), centre, scale


def with_difference(
    df: DataFrame, pairs: tuple[tuple[bytes, bytes], ...], text: str = "text"
) -> DataFrame:
    """``df`` with the normalised size difference of every whole text in __difference."""
    def factory():
        sizes = Sizes(pairs)

        def compute(column: pa.Array):
            return [[difference(t, sizes) for t in utf8(column)]]
        return compute

    field = T.StructField("__difference", T.DoubleType())
    return add_columns(df, [text], T.StructType([field]), factory)


def score(
    df: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """``df`` with score (0 to 1, higher: better) and predicted (1 from ``threshold`` on).

    Null text counts as empty; empty texts get the score of the calibration at no
    difference. Without a model every score is 0.5. Whole texts are compressed, piece by
    piece. Columns named like an output are replaced, others pass through; repeated rows
    get equal scores; an empty table gives an empty result.
    """
    outputs = T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    ])

    def factory():
        sizes = Sizes(model.pairs) if model else None

        def compute(column: pa.Array):
            if model is None:
                scores = np.full(len(column), 0.5)
            else:
                raw = np.array([difference(t, sizes) for t in utf8(column)], float)
                bias, weight = model.weights
                z = bias + weight * (raw - model.centre) / model.scale
                scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return [scores.tolist(), (scores >= threshold).astype(int).tolist()]
        return compute

    return add_columns(df, [text], outputs, factory)
