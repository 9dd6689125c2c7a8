"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_batches, stored


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links (member, smallest member) with the same components as the links (a, b).

    Minimum labels with pointer jumping over numpy arrays; at most one row per node.
    """
    if not len(a):
        return np.empty((0, 2), np.int64)
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        # hook the roots of both ends below the smaller one
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            break
    moved = label != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1).astype(np.int64)


def contracted(links: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """Links with the same components, thinned within each task to a forest.

    At most ``rows`` links are held at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += len(batch)
            if size >= rows:
                made = forest(*map(np.concatenate, zip(*held)))
                if len(made) > rows // 2:  # it doesn't shrink any more: pass it on
                    yield _batch(made)
                    held, size = [], 0
                else:
                    held, size = [(made[:, 0], made[:, 1])], len(made)
        if held:
            yield _batch(forest(*map(np.concatenate, zip(*held))))

    def _batch(made: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"]
        )

    return map_batches(links.select("a", "b"), run, "a bigint, b bigint")


def components(
    spark: SparkSession, links: DataFrame, rounds: int = 60, task_links: int = 1 << 20
) -> DataFrame:
    """(node, root): for every node of a link, the smallest node of its component.

    ``links`` has the BIGINT columns a and b. In each round, tasks of about ``task_links``
    links first thin theirs to a forest. Then every node's larger neighbours move to its
    smallest one, and after that its smaller neighbours, until every component is a star
    around its smallest node; the rounds grow with the logarithm of the longest path. What
    fits in one task is settled by the thinning. Both steps aggregate before they join, and
    a hub's row is never a list. A table without links gives an empty result.
    """
    edges = stored(spark, links.where("a <> b").select("a", "b"), "links")
    state = _state(edges)
    for _ in range(rounds):
        tasks = -(-state[0] // task_links)
        if not tasks:
            break
        thinned = contracted(edges.coalesce(tasks))
        if tasks == 1:
            edges = stored(spark, thinned, "links")
            break
        edges = stored(spark, _starred(thinned), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle; raise rounds")
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return named.unionByName(named.select("root").distinct().select(F.col("root").alias("node"), "root"))


def _starred(links: DataFrame) -> DataFrame:
    """One round of links (a, b), b < a, moved towards their smallest nodes."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # larger neighbours: every node's neighbours above it move to its smallest one
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("low"))
    above = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    edges = above.where("u <> v").distinct()
    # smaller neighbours: a node and the neighbours below it move to its smallest one
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    own = low.select(F.col("u").alias("a"), F.col("low").alias("b"))
    return moved.where("a <> b").unionByName(own).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of links and a sum of their hashes, which tell whether a round changed them."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)
