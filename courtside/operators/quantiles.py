"""Exact quantiles of columns too long for one task to hold.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so
it is used only where the groups are known to be small. Longer groups are
narrowed: a pass counts the values in bins between the ends of an interval,
keeps the bin each wanted rank falls into, with the bin's own smallest and
largest value as the new ends, and goes on until an interval holds few enough
values to be sorted. Counts are exact, so the ranks are. The intervals are a
stored table, joined and aggregated each pass: only their number reaches the
driver, so there may be as many long groups as the data have.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.text import is_finite
from courtside.operators.windows import BROADCAST_ROWS
from courtside.session import materialize

# Most values of a group that are sorted in one task.
SORT_ROWS = 500_000

# Bins per narrowing pass.
BINS = 2048

# What tells intervals apart: their group and how many of its values lie below them.
_INTERVAL = ("group", "column", "n", "below", "ranks")


def long_numbers(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """(group, column, value) of all finite numbers: NULL, NaN and infinities are no measurements."""
    group = F.col(by).cast("string") if by else F.lit("all")
    wide = df.select(group.alias("group"), *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(["group"], list(columns), "column", "value").where(is_finite(F.col("value")))


def _heights(probabilities: Sequence[float]) -> list[Column]:
    """Per probability the place of its quantile among the ``n`` sorted values; ranks start at 0."""
    return [(F.col("n") - 1) * F.lit(float(p)) for p in probabilities]


def _small(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def _inside(numbers: DataFrame, intervals: DataFrame, n_intervals: int) -> DataFrame:
    """The values of each interval, next to it."""
    edges = intervals.withColumnsRenamed({"group": "_group", "column": "_column"})
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("column") == F.col("_column"))
    return numbers.join(_small(edges, n_intervals), same & F.col("value").between(F.col("low"), F.col("high")))


def _narrow(numbers: DataFrame, intervals: DataFrame, n_intervals: int) -> DataFrame:
    """The bins of the intervals that hold a wanted rank, as intervals."""
    # The smallest value goes to the first bin and the largest to the last, so
    # every pass narrows. Halves keep the width of the widest interval finite.
    reach = F.col("high") - F.col("low")
    halves = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    place = F.when(reach < float("inf"), (F.col("value") - F.col("low")) / reach).otherwise(halves)
    bins = (
        _inside(numbers, intervals, n_intervals)
        .withColumn("bin", F.least(F.floor(place * BINS), F.lit(BINS - 1)))
        .groupBy(*_INTERVAL, "bin")
        .agg(F.count(F.lit(1)).alias("inside"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most BINS rows to a window.
    before = Window.partitionBy(*_INTERVAL).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("inside").over(before), F.lit(0))
    held = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("inside")))
    return (
        bins.withColumn("start", start)
        .withColumn("ranks", held)
        .where(F.size("ranks") > 0)
        .select("group", "column", "n", F.col("start").alias("below"), "inside", "low", "high", "ranks")
    )


def _values_at(numbers: DataFrame, sizes: DataFrame, probabilities: Sequence[float], sort_rows: int) -> DataFrame:
    """(group, column, n, rank, value) of the ranks that the quantiles of long groups lie between."""
    ranks = [end(h).cast("bigint") for h in _heights(probabilities) for end in (F.floor, F.ceil)]
    intervals = sizes.where(F.col("n") > sort_rows).select(
        "group", "column", "n", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("inside"), "low", "high",
        F.array_distinct(F.array(*ranks)).alias("ranks"),
    )
    one_value = F.col("low") == F.col("high")
    sortable = ~one_value & (F.col("inside") <= sort_rows)
    found = []
    while True:
        intervals = materialize(intervals, "intervals")
        # Three counts are all that reaches the driver.
        n_one, n_sortable, n_all = intervals.agg(F.count_if(one_value), F.count_if(sortable), F.count(F.lit(1))).first()
        if n_one:
            found.append(intervals.where(one_value).select("group", "column", "n", F.explode("ranks").alias("rank"), F.col("low").alias("value")))
        if n_sortable:
            lists = (
                _inside(numbers, intervals.where(sortable), n_sortable)
                .groupBy(*_INTERVAL)
                .agg(F.sort_array(F.collect_list("value")).alias("values"))
            )
            at = F.get("values", (F.col("rank") - F.col("below")).cast("int"))
            found.append(lists.withColumn("rank", F.explode("ranks")).select("group", "column", "n", "rank", at.alias("value")))
        n_wide = n_all - n_one - n_sortable
        if not n_wide:
            return reduce(DataFrame.unionByName, found)
        intervals = _narrow(numbers, intervals.where(~one_value & ~sortable), n_wide)


def _narrowed_quantiles(numbers: DataFrame, sizes: DataFrame, probabilities: Sequence[float], sort_rows: int) -> DataFrame:
    """(group, column, n, quantiles) of the groups with more than ``sort_rows`` values."""
    # Two values a probability and group.
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "value")))
    held = _values_at(numbers, sizes, probabilities, sort_rows).groupBy("group", "column", "n").agg(by_rank.alias("at"))
    quantiles = []
    for height in _heights(probabilities):
        a, b = (F.element_at("at", end(height).cast("bigint")) for end in (F.floor, F.ceil))
        part = height - F.floor(height)
        quantiles.append(F.when(a == b, a).otherwise(a * (1 - part) + b * part))
    return held.select("group", "column", "n", F.array(*quantiles).alias("quantiles"))


def quantiles_and_groups(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    sort_rows: int = SORT_ROWS,
) -> tuple[DataFrame, int]:
    """:func:`exact_quantiles`, and how many rows it has."""
    numbers = long_numbers(df, columns, by)
    sizes = materialize(
        numbers.groupBy("group", "column").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        ),
        "sizes",
    )
    n_groups, n_long = sizes.agg(F.count(F.lit(1)), F.count_if(F.col("n") > sort_rows)).first()

    points = F.array(*[F.lit(float(p)) for p in probabilities])
    short = numbers
    if n_long:
        names = sizes.where(F.col("n") > sort_rows).select(F.col("group").alias("_group"), F.col("column").alias("_column"))
        same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("column") == F.col("_column"))
        short = numbers.join(_small(names, n_long), same, "left_anti")
    result = short.groupBy("group", "column").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("value", points).alias("quantiles")
    )
    if n_long:
        result = result.unionByName(_narrowed_quantiles(numbers, sizes, probabilities, sort_rows))
    return result, n_groups


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """(group, column, n, quantiles) with linear interpolation between ranks.

    Groups come from the column ``by``; without it there is one, 'all'.
    """
    return quantiles_and_groups(df, columns, probabilities, by, sort_rows)[0]
