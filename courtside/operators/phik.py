"""PhiK correlation between columns of any kind (Baak et al., arXiv:1811.11440).

Spark counts the contingency tables of all column pairs and reduces each to one
chi-square. The correlation of a binned normal distribution with that chi-square
is then searched for all pairs at once: each round tells the chi-squares of 31
correlations within what is left of a pair's interval, summed from blocks of bins
that tasks integrate apart from one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.constants import CORRELATION_THRESHOLD, PHIK_BINS
from courtside.operators.cleaning import varying_columns
from courtside.session import materialize, ship_package

# The binned normal distribution spans so many deviations to both sides.
SPAN = 5.0

# Neighbouring bins that are narrower than this share of the deviation of one
# side given the other are integrated as one: the chi-square is right to a part
# in 50,000 then, however many bins there are.
RESOLUTION = 1 / 64

# A round of the search cuts an interval into so many parts, and the last round
# leaves one of SECTIONS ** -ROUNDS, in which the correlation is interpolated.
SECTIONS, ROUNDS = 32, 3

# Points of the normal distribution that one block evaluates, about.
BLOCK_POINTS = 250_000


def binned(df: DataFrame, interval_columns: Sequence[str], bins: int = PHIK_BINS) -> DataFrame:
    """Interval columns as numbers of equal bins, closed above; other columns as text.

    Constant columns, which have no correlation, are left out.
    """
    columns = varying_columns(df)
    intervals = [c for c in columns if c in interval_columns]
    row = (
        df.agg(*[F.min(F.col(c).cast("double")).alias(f"low_{i}") for i, c in enumerate(intervals)],
               *[F.max(F.col(c).cast("double")).alias(f"high_{i}") for i, c in enumerate(intervals)]).first()
        if intervals
        else {}
    )

    def bin_number(i: int, c: str):
        low, high = row[f"low_{i}"], row[f"high_{i}"]
        part = (F.col(c).cast("double") - F.lit(low)) / F.lit(high - low) * bins
        return F.greatest(F.ceil(part), F.lit(1)).cast("string").alias(c)

    return df.select(
        *[bin_number(intervals.index(c), c) if c in intervals else F.col(c).cast("string").alias(c) for c in columns]
    )


def contingency_chi2(df: DataFrame) -> DataFrame:
    """(column_1, column_2, n, n_1, n_2, chi2) for every pair of columns.

    Each row adds one to one cell per pair; cells are summed in each task before
    they travel, so the shuffle is as large as the tables, not as the data. The
    tables are stored, as their row and column totals are taken from them too.
    """
    columns = df.columns
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    entries = [
        F.struct(F.lit(k).alias("pair"), F.col(a).alias("a"), F.col(b).alias("b")) for k, (a, b) in enumerate(pairs)
    ]
    cells = materialize(
        df.select(F.inline(F.array(*entries)))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("pair", "a", "b")
        .agg(F.count(F.lit(1)).cast("double").alias("o")),
        "cells",
    )
    rows = cells.groupBy("pair", "a").agg(F.sum("o").alias("row"))
    cols = cells.groupBy("pair", "b").agg(F.sum("o").alias("col"))
    sizes_1 = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n_1"))
    sizes_2 = cols.groupBy("pair").agg(F.count(F.lit(1)).alias("n_2"))
    shares = (
        cells.join(rows, ["pair", "a"])
        .join(cols, ["pair", "b"])
        .groupBy("pair")
        .agg(F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("row") * F.col("col"))).alias("share"))
    )
    names = F.array(*[F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2")) for a, b in pairs])
    return (
        shares.join(sizes_1, "pair")
        .join(sizes_2, "pair")
        .select(
            F.get(names, F.col("pair"))["column_1"].alias("column_1"),
            F.get(names, F.col("pair"))["column_2"].alias("column_2"),
            F.col("n").cast("bigint").alias("n"), "n_1", "n_2",
            F.greatest(F.col("n") * (F.col("share") - 1), F.lit(0.0)).alias("chi2"),
        )
    )


# The normal distribution function, tabulated once and interpolated by cubics
# from its values and slopes, which is exact to about 1e-14.
_STEP = 1e-3
_GRID = np.arange(-9.0, 9.0 + _STEP / 2, _STEP)
_CDF = np.array([0.5 * math.erfc(-x / math.sqrt(2)) for x in _GRID])
_SLOPE = np.exp(-0.5 * _GRID * _GRID) / math.sqrt(2 * math.pi) * _STEP


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    place = (np.clip(x, _GRID[0], _GRID[-1]) - _GRID[0]) / _STEP
    i = np.minimum(place.astype(np.int64), len(_GRID) - 2)
    t = place - i
    rise = _CDF[i + 1] - _CDF[i]
    curve = t * (1 - t) * ((1 - t) * (_SLOPE[i] - rise) + t * (rise - _SLOPE[i + 1]))
    return _CDF[i] + t * rise + curve


def _gauss(edges: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points and weighted normal densities between neighbouring edges, and the interval of each point.

    Intervals are cut into equal parts of at most ``step``; parts much narrower
    than that take fewer points.
    """
    widths = np.diff(edges)
    parts = np.maximum(np.ceil(widths / step), 1).astype(np.int64)
    nodes, weights = np.polynomial.legendre.leggauss(3 if widths.max() <= step / 8 else 8)
    interval = np.repeat(np.arange(len(widths)), parts)
    number = np.arange(len(interval)) - np.repeat(np.cumsum(parts) - parts, parts)
    half = (widths / parts / 2)[interval]
    x = (edges[interval] + half * (2 * number + 1))[:, None] + half[:, None] * nodes
    density = half[:, None] * weights * np.exp(-0.5 * x * x) / math.sqrt(2 * math.pi)
    return x.ravel(), density.ravel(), np.repeat(interval, len(nodes))


def _grouped_edges(n: int, scale: float, first: int = 0, last: int | None = None) -> np.ndarray:
    """Edges of the groups ``first`` to ``last`` of ``n`` equal bins, taken together up to the resolution."""
    size = _group_size(n, scale)
    edges = np.arange(first, (-(-n // size) if last is None else last) + 1) * size
    return np.minimum(edges, n) * (2 * SPAN / n) - SPAN


def _group_size(n: int, scale: float) -> int:
    return max(1, int(scale * RESOLUTION * n / (2 * SPAN)))


@lru_cache(maxsize=16)
def _masses(rho: float, n: int) -> np.ndarray:
    """Mass of each group of bins of a side, the other side within the span."""
    scale = math.sqrt(1 - rho * rho)
    edges = _grouped_edges(n, scale)
    y, density, group = _gauss(edges, scale)
    kept = _normal_cdf((SPAN - rho * y) / scale) - _normal_cdf((-SPAN - rho * y) / scale)
    return np.bincount(group, weights=density * kept, minlength=len(edges) - 1)


def _block_share(rho: float, n_1: int, n_2: int, block: int, blocks: int) -> float:
    """Sum of p^2 / (row * column) over one of ``blocks`` ranges of groups of the first side's bins."""
    scale = math.sqrt(1 - rho * rho)
    groups = -(-n_1 // _group_size(n_1, scale))
    edges = _grouped_edges(n_1, scale, block * groups // blocks, (block + 1) * groups // blocks)
    if len(edges) < 2:
        return 0.0
    columns, masses = _grouped_edges(n_2, scale), _masses(rho, n_2)
    x, density, row = _gauss(edges, scale)
    # Stretches of x two deviations wide: beyond nine deviations of them there is no mass.
    cuts = np.searchsorted(x, np.arange(x[0], x[-1] + 4 * scale, 2 * scale))
    total, open_row, open_cells = 0.0, -1, np.zeros(0)

    def close(cells: np.ndarray) -> float:
        whole = cells.sum()
        return float((cells * cells / masses).sum() / whole) if whole > 0 else 0.0

    for start, stop in zip(cuts[:-1], cuts[1:]):
        if start == stop:
            continue
        low = max(int(np.searchsorted(columns, rho * x[start] - 9 * scale)) - 1, 0)
        high = min(int(np.searchsorted(columns, rho * x[stop - 1] + 9 * scale)) + 1, len(columns))
        shares = np.diff(_normal_cdf((columns[None, low:high] - rho * x[start:stop, None]) / scale), axis=1)
        shares *= density[start:stop, None]
        starts = np.flatnonzero(np.diff(row[start:stop], prepend=-1))
        cells = np.add.reduceat(shares, starts, axis=0)
        rows = row[start:stop][starts]
        # The first and the last row may go on in the next stretch.
        if rows[0] == open_row:
            open_cells[low : high - 1] += cells[0]
            cells, rows = cells[1:], rows[1:]
        if len(rows):
            if open_row >= 0:
                total += close(open_cells)
            inner = cells[:-1]
            sums = inner.sum(axis=1)
            part = (inner * inner / masses[low : high - 1]).sum(axis=1)
            total += float(np.divide(part, sums, out=np.zeros_like(part), where=sums > 0).sum())
            open_row, open_cells = int(rows[-1]), np.zeros(len(masses))
            open_cells[low : high - 1] = cells[-1]
    return total + close(open_cells)


def _overlap_share(n_1: int, n_2: int, block: int, blocks: int) -> float:
    """The same where both sides are one variable, over a range of the second side's bins, of which there are no fewer.

    A bin of the second side lies in one of the first, or in two neighbours.
    """
    j = np.arange(block * n_2 // blocks, (block + 1) * n_2 // blocks, dtype=np.int64)
    if not len(j):
        return 0.0
    left, right = j * n_1 // n_2, ((j + 1) * n_1 - 1) // n_2

    def cdf(number: np.ndarray, n: int) -> np.ndarray:
        return _normal_cdf(number * (2 * SPAN / n) - SPAN)

    low, high = cdf(j, n_2), cdf(j + 1, n_2)
    middle = np.where(left == right, high, cdf(right, n_1))
    first = (middle - low) ** 2 / (cdf(left + 1, n_1) - cdf(left, n_1))
    second = (high - middle) ** 2 / (cdf(right + 1, n_1) - cdf(right, n_1))
    return float(((first + second) / (high - low)).sum())


def _share(rho: float, n_1: int, n_2: int, block: int = 0, blocks: int = 1) -> float:
    if rho >= 1:
        return _overlap_share(n_1, n_2, block, blocks)
    return _block_share(rho, n_1, n_2, block, blocks)


def _share_batches(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for columns in batches:
        yield pd.Series([_share(*row) for row in zip(*columns)], dtype="float64")


def _block_count(rho: Column) -> Column:
    """Blocks of a table: about as many as its points fill, and no more than its rows of groups."""
    scale = F.sqrt(1 - rho * rho)
    groups = F.lit(2 * SPAN / RESOLUTION) / scale
    rows, columns = F.least(F.col("small"), groups), F.least(F.col("large"), groups)
    points = (rows * 3 + F.lit(32 * SPAN) / scale) * columns
    below = F.least(F.ceil(points / BLOCK_POINTS), F.ceil(rows))
    return F.when(rho >= 1, F.ceil(F.col("large") / BLOCK_POINTS)).otherwise(below)


def normal_chi2(shapes: DataFrame, parts: int = SECTIONS**ROUNDS) -> DataFrame:
    """(small, large, place, model) with the chi-square per row of the binned normal distribution.

    ``shapes`` has distinct (small, large, place): the bins of both sides, fewer
    first, and the correlation in ``parts`` of one. Blocks of bins are spread
    over the cluster and their sums added up.
    """
    ship_package(shapes.sparkSession)
    share = F.pandas_udf("double")(_share_batches)
    rho = F.col("place") / F.lit(float(parts))
    blocks = (
        shapes.withColumn("rho", rho)
        .withColumn("blocks", F.greatest(_block_count(F.col("rho")), F.lit(1)).cast("bigint"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        # Few rows with much work in each, which a planner that goes by bytes would put into one task.
        .repartition(shapes.sparkSession.sparkContext.defaultParallelism, "small", "large", "place", "block")
    )
    return (
        blocks.select("small", "large", "place", share("rho", "small", "large", "block", "blocks").alias("share"))
        .groupBy("small", "large", "place")
        .agg((F.sum("share") - 1).alias("model"))
    )


def phik_from_chi2(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``phik``: the correlation whose binned normal distribution has the chi-square, noise taken off.

    ``pairs`` has (column_1, column_2, n, n_1, n_2, chi2). The chi-square rises
    with the correlation, so each round keeps one of the parts of a pair's
    interval. Intervals are a stored table of a row per pair; pairs of one shape
    share their values. Tables without rows or of one bin a side are 0.
    """
    parts = SECTIONS**ROUNDS
    noise = (F.col("n_1") - 1) * (F.col("n_2") - 1)
    greatest = F.col("n") * (F.least("n_1", "n_2") - 1)
    shape = ["small", "large"]
    table = pairs.select(
        "*", F.least("n_1", "n_2").alias("small"), F.greatest("n_1", "n_2").alias("large"),
        F.when((F.least("n_1", "n_2") < 2) | (F.col("n") == 0) | (F.col("chi2") <= noise), F.lit(0.0))
        .when((F.col("chi2") >= greatest) | (noise >= greatest), F.lit(1.0)).alias("settled"),
        F.try_divide(F.col("chi2") - noise, greatest - noise).alias("part"),
    )
    table = materialize(table, "pairs")
    is_open = F.col("settled").isNull()
    # Up to SECTIONS models a pair and round, in the order of their places; the first round also tells that of 1.
    state = table.where(is_open).select(
        "column_1", "column_2", *shape, "part", F.lit(None).cast("double").alias("wanted"),
        F.lit(0).cast("bigint").alias("low"), F.lit(0.0).alias("at_low"), F.lit(None).cast("double").alias("at_high"),
    )
    for number in range(1, ROUNDS + 1):
        step = SECTIONS ** (ROUNDS - number)
        last = SECTIONS if number == 1 else SECTIONS - 1
        inner = F.sequence(F.col("low") + step, F.col("low") + last * step, F.lit(step).cast("bigint"))
        places = state.withColumn("place", F.explode(inner))
        values = places.join(normal_chi2(places.select(*shape, "place").distinct()), [*shape, "place"])
        models = values.groupBy(*state.columns).agg(F.array_sort(F.collect_list("model")).alias("models"))
        if number == 1:
            models = models.withColumns({"wanted": F.col("part") * F.get("models", F.lit(SECTIONS - 1)),
                                         "at_high": F.get("models", F.lit(SECTIONS - 1))})
        passed = F.size(F.filter("models", lambda model: model < F.col("wanted")))
        state = materialize(
            models.withColumn("passed", passed).select(
                "column_1", "column_2", *shape, "part", "wanted",
                (F.col("low") + F.col("passed") * step).alias("low"),
                F.coalesce(F.get("models", F.col("passed") - 1), "at_low").alias("at_low"),
                F.coalesce(F.get("models", F.col("passed")), "at_high").alias("at_high"),
            ),
            "intervals",
        )
    # The chi-square starts out as the square of the correlation.
    low, high = F.sqrt(F.greatest("at_low", F.lit(0.0))), F.sqrt("at_high")
    within = F.try_divide(F.sqrt("wanted") - low, high - low)
    found = state.select(
        "column_1", "column_2",
        ((F.col("low") + F.least(F.greatest(F.coalesce(within, F.lit(0.5)), F.lit(0.0)), F.lit(1.0))) / parts).alias("found"),
    )
    return table.join(found, ["column_1", "column_2"], "left").select(
        *pairs.columns, F.coalesce("settled", "found").alias("phik")
    )


def phik_pairs(df: DataFrame, interval_columns: Sequence[str], bins: int = PHIK_BINS) -> DataFrame:
    """(column_1, column_2, n, n_1, n_2, chi2, phik) for every pair of columns that vary."""
    return phik_from_chi2(contingency_chi2(binned(df, interval_columns, bins)))


def high_correlations(pairs: DataFrame, threshold: float = CORRELATION_THRESHOLD) -> DataFrame:
    """(column_1, column_2, correlation) of the pairs at or above the threshold, to four places."""
    return pairs.where(F.col("phik").isNotNull() & (F.col("phik") >= threshold)).select(
        "column_1", "column_2", F.round("phik", 4).alias("correlation")
    )


def compare_correlations(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column_1, column_2, before, after) of the pairs present in either."""
    return before.select("column_1", "column_2", F.col("phik").alias("before")).join(
        after.select("column_1", "column_2", F.col("phik").alias("after")), ["column_1", "column_2"], "full"
    )
