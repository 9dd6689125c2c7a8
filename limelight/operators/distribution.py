"""Histograms, exact quantiles and platform normalisation without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import ratio
from ..session import remove_path, scratch_dir


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are kept.

    The range is a scalar subquery, counting is a map-side aggregate into ``bins`` groups.
    A column with one distinct value is binned over that value plus or minus one half; a
    column without values has no bins.
    """
    spark = df.sparkSession
    value = F.col(column).cast("double")
    present = df.select(value.alias("x")).where(F.col("x").isNotNull())
    low, high = F.min("x"), F.max("x")
    half = F.when(low == high, 0.5).otherwise(0.0)
    bounds = present.agg(
        F.struct((low - half).alias("low"), (high + half).alias("high")).alias("bounds")
    )
    spread = bounds.scalar()
    # the maximum itself belongs to the last bin
    position = F.floor((F.col("x") - spread["low"]) / (spread["high"] - spread["low"]) * bins)
    counts = (
        present.select(F.least(position, F.lit(bins - 1)).alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    edges = (
        spark.range(bins).select(F.col("id").alias("bin"), spread.alias("b"))
        .where(F.col("b.low").isNotNull())
    )
    step = (F.col("b")["high"] - F.col("b")["low"]) / bins
    return (
        edges.join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
        .select(
            "bin",
            (F.col("b")["low"] + F.col("bin") * step).alias("lower_edge"),
            (F.col("b")["low"] + (F.col("bin") + 1) * step).alias("upper_edge"),
            F.coalesce("n", F.lit(0)).alias("artists"),
        )
    )


def share_above(df: DataFrame, column: str, line: float = 1.0) -> DataFrame:
    """Share of non-NULL values above a reference line."""
    above = F.count_if(F.col(column) > line)
    return df.agg(
        F.count(column).alias("artists"), above.alias("above"),
        ratio(above, F.count(column)).alias("share_above"),
    )


@dataclass(frozen=True)
class _Bracket:
    """Values of one metric strictly between two others (None: no end), and wanted ranks."""

    metric: str
    low: float | None
    high: float | None
    before: int  # values of the metric up to the bracket
    size: int
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        value = F.col(self.metric)
        inside = value.isNotNull()
        if self.low is not None:
            inside &= value > F.lit(self.low)
        if self.high is not None:
            inside &= value < F.lit(self.high)
        return inside


def _narrowed(
    values: DataFrame, brackets: list[_Bracket], margin: float, accuracy: int,
    found: dict[tuple[str, int], float],
) -> list[_Bracket]:
    """Cut brackets around their ranks; ranks that fall on a cut are found.

    Two aggregates of one row each: sketches give cuts just below and above every rank, and
    exact counts tell where the ranks lie, whatever the sketches' error. A value that fills
    a third of the table becomes a cut and is settled by its count.
    """
    sketches = []
    for i, b in enumerate(brackets):
        shares = [(r - b.before + 0.5) / b.size for r in b.ranks]
        edges = sorted({min(max(s + side, 0.0), 1.0) for s in shares for side in (-margin, margin)})
        inside = F.when(b.holds(), F.col(b.metric))
        sketches.append(F.percentile_approx(inside, edges, accuracy).alias(str(i)))
    cuts = [sorted(set(c)) for c in values.agg(*sketches).first()]
    counts = [
        F.struct(*[
            F.count_if(b.holds() & condition).alias(f"n{j}")
            for j, condition in enumerate(
                x for cut in own for x in (F.col(b.metric) < F.lit(cut), F.col(b.metric) == F.lit(cut))
            )
        ]).alias(str(i))
        for i, (b, own) in enumerate(zip(brackets, cuts))
    ]
    out = []
    for b, own, row in zip(brackets, cuts, values.agg(*counts).first()):
        low, start, left = b.low, 0, list(b.ranks)
        for cut, below, equal in zip([*own, None], [*row[::2], b.size], [*row[1::2], 0]):
            inner = tuple(r for r in left if start <= r - b.before < below)
            if inner:
                out.append(_Bracket(b.metric, low, b.high if cut is None else cut, b.before + start,
                                    below - start, inner))
            found.update({(b.metric, r): cut for r in left if below <= r - b.before < below + equal})
            low, start = cut, below + equal
    return out


def _ranked_values(
    values: DataFrame, columns: Sequence[str], ranks: dict[str, set[int]], sizes: dict[str, int],
    margin: float, accuracy: int, task_rows: int,
) -> dict[tuple[str, int], float]:
    """The value at each wanted rank (from 0) of each metric."""
    found: dict[tuple[str, int], float] = {}
    brackets = [_Bracket(c, None, None, 0, sizes[c], tuple(sorted(ranks[c]))) for c in columns if sizes[c]]
    while wide := [b for b in brackets if b.size > task_rows]:
        narrow = [b for b in brackets if b.size <= task_rows]
        brackets = narrow + _narrowed(values, wide, margin, accuracy, found)
    if brackets:
        # a row goes to the few brackets that hold it; each is one small sorted group
        places = F.filter(
            F.array(*[
                F.when(b.holds(), F.struct(F.lit(i).alias("bracket"), F.col(b.metric).alias("value")))
                for i, b in enumerate(brackets)
            ]), F.isnotnull,
        )
        order = Window.partitionBy("bracket").orderBy("value")
        wanted = reduce(or_, [
            (F.col("bracket") == i) & F.col("place").isin([r - b.before for r in b.ranks])
            for i, b in enumerate(brackets)
        ])
        picked = (
            values.select(F.inline(places)).withColumn("place", F.row_number().over(order) - 1)
            .where(wanted)
        )
        for row in picked.collect():  # at most two rows per metric and probability
            b = brackets[row["bracket"]]
            found[b.metric, b.before + row["place"]] = row["value"]
    return found


def _kept_values(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, str]:
    """The columns as doubles, written once to scratch space, and where."""
    path = scratch_dir(df.sparkSession, "values")
    df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _quantiles(
    values: DataFrame, sizes: dict[str, int], columns: Sequence[str],
    probabilities: Sequence[float], margin: float, accuracy: int, task_rows: int,
) -> list[tuple[str, float, float]]:
    position = {(c, p): (sizes[c] - 1) * p for c in columns if sizes[c] for p in probabilities}
    ranks = {c: set() for c in columns}
    for (c, _), x in position.items():
        ranks[c] |= {math.floor(x), math.ceil(x)}
    found = _ranked_values(values, columns, ranks, sizes, margin, accuracy, task_rows)
    out = []
    for (c, p), x in position.items():
        low, high = found[c, math.floor(x)], found[c, math.ceil(x)]
        out.append((c, float(p), low + (high - low) * (x - math.floor(x))))
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    margin: float = 0.002, accuracy: int = 1_000, task_rows: int = 100_000,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per (metric, probability).

    Brackets around the wanted ranks are narrowed by sketches and exact counts until each
    holds at most ``task_rows`` values, and only those are sorted. Each narrowing keeps
    about two ``margin`` of a bracket, so two passes serve 10**10 rows. The columns are
    read from ``df`` once; what comes to the driver is bounded by the arguments.
    """
    values, path = _kept_values(df, columns)
    counts = values.agg(*[F.count(f"`{c}`").alias(c) for c in columns]).first().asDict()
    rows = _quantiles(values, counts, columns, probabilities, margin, accuracy, task_rows)
    remove_path(df.sparkSession, path)
    return df.sparkSession.createDataFrame(rows, "metric string, probability double, quantile double")


def describe_scores(
    df: DataFrame, columns: Sequence[str], margin: float = 0.002, accuracy: int = 1_000,
    task_rows: int = 100_000,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    values, path = _kept_values(df, columns)
    moments = values.agg(*[
        F.struct(
            F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(c)
        for c in columns for x in [F.col(f"`{c}`")]
    ]).first()
    sizes = {c: moments[c]["n"] for c in columns}
    quartiles: dict[str, list[float]] = {c: [] for c in columns}
    for c, _, value in _quantiles(values, sizes, columns, (0.25, 0.5, 0.75), margin, accuracy, task_rows):
        quartiles[c].append(value)
    remove_path(df.sparkSession, path)
    rows = [
        (c, m["n"], m["mean"], m["std"], m["min"], *quartiles[c], m["max"])
        for c in columns for m in [moments[c]] if m["n"]
    ]
    return df.sparkSession.createDataFrame(rows, (
        "metric string, n bigint, mean double, std double, min double, q25 double, "
        "q50 double, q75 double, max double"
    ))


def platform_normalised(df: DataFrame) -> DataFrame:
    """Each platform's metric as a percentage of its maximum, long form.

    Missing metrics count 0; a platform nobody is on has maximum 1.
    """
    platforms = {
        "Last.fm": "lastfm_listeners",
        "Instagram": "instagram_followers",
        "YouTube": "youtube_subscribers",
    }
    maxima = df.agg(F.struct(*[
        F.coalesce(F.max(c), F.lit(1)).alias(c) for c in platforms.values()
    ]).alias("m")).scalar()

    def percent(column: str) -> Column:
        return F.coalesce(ratio(F.col(column), maxima[column]) * 100, F.lit(0.0))

    entries = F.array(*[
        F.struct(F.lit(name).alias("platform"), percent(c).alias("score"))
        for name, c in platforms.items()
    ])
    return df.select("artist_id", "artist_name", F.inline(entries))
