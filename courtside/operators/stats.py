"""Distribution statistics: histograms, box summaries, densities, power transforms, id gaps."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from courtside.constants import HISTOGRAM_BINS
from courtside.operators.profile import few_values
from courtside.operators.quantiles import SORT_ROWS, exact_quantiles, long_numbers, quantiles_and_groups
from courtside.operators.windows import BROADCAST_ROWS
from courtside.session import materialize, ship_package

QUARTILES = (0.25, 0.5, 0.75)


# Values are counted before further work when a column has this many rows per
# distinct value; with fewer, the counting shuffle would cost more than it saves.
ROWS_PER_VALUE = 20

# Up to so many values are spread over the cores by hand.
SPREAD_ROWS = 5_000_000


def ranges_of(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """Per column n, about how many distinct values, ends, mean and deviation, in one pass."""
    rows = (
        long_numbers(df, columns)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.approx_count_distinct("value").alias("n_values"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
        )
        .collect()
    )
    return {row["column"]: row for row in rows}


def weighted_values(df: DataFrame, ranges: Mapping[str, Row]) -> DataFrame:
    """(column, value, w): values of columns with few distinct ones counted, others as they come.

    The counts are stored, as several passes use them. Where all values are few
    rows, they are spread over the cores, as every row is about to be worked on
    a hundred times; larger inputs come in enough partitions.
    """
    spark = df.sparkSession
    few = [c for c, row in ranges.items() if row["n_values"] * ROWS_PER_VALUE <= row["n"]]
    many = [c for c in ranges if c not in few]
    parts = []
    if few:
        counts = long_numbers(df, few).groupBy("column", "value").agg(F.count(F.lit(1)).alias("w"))
        parts.append(materialize(counts, "counted"))
    if many:
        values = long_numbers(df, many).select("column", "value", F.lit(1).cast("bigint").alias("w"))
        if sum(ranges[c]["n"] for c in many) <= SPREAD_ROWS:
            values = values.repartition(spark.sparkContext.defaultParallelism)
        parts.append(values)
    return reduce(DataFrame.unionByName, parts)


def _edges(row: Row) -> tuple[float, float]:
    """Ends of a histogram; a single value gets half a unit on both sides."""
    if row["low"] == row["high"]:
        return row["low"] - 0.5, row["high"] + 0.5
    return row["low"], row["high"]


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS, by: str | None = None
) -> DataFrame:
    """(group, column, bin, low, high, count) over equal bins from smallest to largest.

    The bins of a column are the same for all groups; the last one is closed.
    Bins that hold nothing are there with 0.
    """
    ranges = ranges_of(df, columns)
    spark = df.sparkSession
    ends = {c: _edges(row) for c, row in ranges.items()}
    # One row per column: bounded by the schema, not by the data.
    edges = spark.createDataFrame([(c, *e) for c, e in ends.items()], "column string, low double, high double")
    place = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    counts = (
        long_numbers(df, list(ends), by)
        .join(F.broadcast(edges), "column")
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("group", "column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # At most `bins` entries per group and column.
    held = counts.groupBy("group", "column").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("held")
    )
    width = (F.col("high") - F.col("low")) / bins
    bin_number = F.col("bin")
    return (
        held.join(F.broadcast(edges), "column")
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            "group", "column", "bin",
            (F.col("low") + bin_number * width).alias("low"),
            (F.col("low") + (bin_number + 1) * width).alias("high"),
            F.coalesce(F.try_element_at("held", bin_number), F.lit(0)).alias("count"),
        )
    )


def box_summary(
    df: DataFrame, columns: Sequence[str], by: str | None = None, sort_rows: int = SORT_ROWS
) -> DataFrame:
    """(group, column, n, q1, median, q3, whiskers, outliers) as a box plot draws them.

    Whiskers end at the last values within 1.5 times the quartile distance.
    """
    quantiles, n_groups = quantiles_and_groups(df, columns, QUARTILES, by, sort_rows)
    q = F.col("quantiles")
    boxes = quantiles.select(
        F.col("group").alias("_group"), F.col("column").alias("_column"),
        q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - 1.5 * (q[2] - q[0])).alias("_from"), (q[2] + 1.5 * (q[2] - q[0])).alias("_to"),
    )
    if n_groups <= BROADCAST_ROWS:
        boxes = F.broadcast(boxes)
    numbers = long_numbers(df, columns, by).join(
        boxes, F.col("group").eqNullSafe(F.col("_group")) & (F.col("column") == F.col("_column"))
    )
    within = F.col("value").between(F.col("_from"), F.col("_to"))
    return numbers.groupBy("group", "column", "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(within, F.col("value"))).alias("whisker_low"),
        F.max(F.when(within, F.col("value"))).alias("whisker_high"),
        F.count_if(~within).alias("n_outliers"),
    )


def left_out(
    df: DataFrame, columns: Sequence[str], hues: Sequence[str], max_columns: int | None = None, max_values: int | None = None
) -> dict[str, str]:
    """What :func:`grouped_quartiles` would leave out under these limits, and why."""
    out = {c: "past the number of columns" for c in (columns[max_columns:] if max_columns is not None else ())}
    for hue in hues:
        if hue not in df.columns:
            out[hue] = "not a column"
        elif max_values is not None and not few_values(df, hue, max_values):
            out[hue] = "too many values"
    return out


def grouped_quartiles(
    df: DataFrame,
    columns: Sequence[str],
    hues: Sequence[str],
    sort_rows: int = SORT_ROWS,
    max_columns: int | None = None,
    max_values: int | None = None,
) -> DataFrame | None:
    """(hue, group, column, n, q1, median, q3) of every column by every hue that is a column.

    ``max_columns`` takes the first columns only and ``max_values`` leaves out
    hues with more values, as a figure would; both are off unless given, and
    :func:`left_out` tells what they leave out. None when no hue is left.
    """
    skipped = left_out(df, columns, hues, max_columns, max_values)
    columns, hues = [c for c in columns if c not in skipped], [h for h in hues if h not in skipped]
    if not hues:
        return None
    # All hues in one long form, so that one pass serves them all.
    keys = F.array(*[F.when(F.col(h).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(h).cast("string"))) for i, h in enumerate(hues)])
    known = df.select(*columns, F.explode(keys).alias("_key")).where(F.col("_key").isNotNull())
    q, place = F.col("quantiles"), F.instr("group", ":")
    return exact_quantiles(known, columns, QUARTILES, "_key", sort_rows).select(
        F.get(F.array(*[F.lit(h) for h in hues]), F.substring_index("group", ":", 1).cast("int")).alias("hue"),
        F.col("group").substr(place + 1, F.length("group")).alias("group"), "column", "n",
        q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
    )


# Width of a cell in bandwidths, and the powers of the distance to its centre
# that are summed in it. With |t| <= 1/8 the terms left out of
# exp(-(z - t)^2 / 2) = exp(-z^2 / 2) * sum(t^k / k! * He_k(z)) come to less than
# 2e-12 of a kernel's peak.
KERNEL_CELL, KERNEL_POWERS = 0.25, 10

# Kernels further away than so many bandwidths, below 1e-16 of their peak, add nothing.
KERNEL_REACH = 9.0


def kernel_density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density): Gaussian kernels, Scott's bandwidth, from smallest to largest value.

    There is no curve, and so no rows, for fewer than two different values. The
    values are reduced to sums of powers in cells a quarter of a bandwidth wide,
    in each task before they travel, and the kernels are applied to the cells:
    what is shuffled is as large as the cells that hold values, not as the data.
    The density is right to 2e-12 / bandwidth; :func:`kernel_density_exact` is
    the plain sum.
    """
    ranges = ranges_of(df, [column])
    row = ranges.get(column)
    if row is None or row["n"] < 2 or row["low"] == row["high"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = row["std"] * row["n"] ** -0.2
    step = (row["high"] - row["low"]) / (points - 1)
    width = h * KERNEL_CELL
    place = (F.col("value") - F.lit(row["low"])) / F.lit(width)
    # In bandwidths, from the centre of the cell.
    t = (place - F.floor(place) - 0.5) * KERNEL_CELL
    cells = (
        long_numbers(df, [column])
        .select(F.floor(place).alias("cell"), t.alias("t"))
        .groupBy("cell")
        .agg(*[F.sum(F.pow("t", F.lit(float(k))) if k else F.lit(1.0)).alias(f"m{k}") for k in range(KERNEL_POWERS)])
    )
    centre = F.lit(row["low"]) + (F.col("cell") + 0.5) * F.lit(width)
    x = F.lit(row["low"]) + F.col("point") * F.lit(step)
    reach = F.lit(h * (KERNEL_REACH + KERNEL_CELL))
    first = F.greatest(F.ceil((centre - reach - F.lit(row["low"])) / F.lit(step)), F.lit(0)).cast("int")
    last = F.least(F.floor((centre + reach - F.lit(row["low"])) / F.lit(step)), F.lit(points - 1)).cast("int")
    near = F.when(first <= last, F.sequence(first, last))
    z = F.col("z")
    # He_k+1(z) = z * He_k(z) - k * He_k-1(z)
    hermite = [F.lit(1.0), z]
    for k in range(1, KERNEL_POWERS - 1):
        hermite.append(z * F.col(f"he{k}") - k * F.col(f"he{k - 1}"))
    spread = cells.withColumn("point", F.explode(near)).withColumn("z", (x - centre) / F.lit(h))
    for k, polynomial in enumerate(hermite):
        spread = spread.withColumn(f"he{k}", polynomial)
    terms = [F.col(f"m{k}") * F.col(f"he{k}") / math.factorial(k) for k in range(KERNEL_POWERS)]
    sums = spread.groupBy("point").agg(F.sum(F.exp(-0.5 * z * z) * sum(terms[1:], terms[0])).alias("_sum"))
    # Points that no kernel reaches have a density of 0; the grid has `points` rows.
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    density = F.greatest(F.coalesce("_sum", F.lit(0.0)), F.lit(0.0)) / F.lit(row["n"] * h * math.sqrt(2 * math.pi))
    return grid.join(sums, "point", "left").select("point", x.alias("x"), density.alias("density"))


def kernel_density_exact(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density): Gaussian kernels, Scott's bandwidth, every value at every point.

    There is no curve, and so no rows, for fewer than two different values.
    Every value adds to all points of the grid within its task, so only
    ``points`` rows per task travel. Where values repeat, they are counted first.
    """
    ranges = ranges_of(df, [column])
    row = ranges.get(column)
    if row is None or row["n"] < 2 or row["low"] == row["high"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = row["std"] * row["n"] ** -0.2
    step = (row["high"] - row["low"]) / (points - 1)
    x = F.lit(row["low"]) + F.col("point") * F.lit(step)
    z = (x - F.col("value")) / F.lit(h)
    return (
        weighted_values(df, ranges)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point")
        .agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_sum"))
        .select("point", x.alias("x"), (F.col("_sum") / F.lit(row["n"] * h * math.sqrt(2 * math.pi))).alias("density"))
    )


# --- Yeo-Johnson ---

# Where the search for the exponent starts, and how its steps shrink.
LAMBDA_LOW, LAMBDA_HIGH, LAMBDA_STEP = -2.0, 4.0, 0.1
LAMBDA_REFINEMENTS = (0.01, 0.001)


def yeo_johnson(x: Column, lam: Column) -> Column:
    """The power transform of ``x`` with exponent ``lam``.

    Both halves are one formula on log(1 + |x|): the exponent is ``lam`` above
    zero and ``2 - lam`` below.
    """
    size = F.log1p(F.abs(x))
    power = F.when(x >= 0, lam).otherwise(2 - lam)
    grown = F.when(power == 0, size).otherwise(F.expm1(power * size) / power)
    return F.when(x >= 0, grown).otherwise(-grown)


def _yeo_johnson_number(x: float, lam: float) -> float:
    """The same for one number: the anchor the sums below are taken around."""
    size, power = math.log1p(abs(x)), lam if x >= 0 else 2 - lam
    return math.copysign(size if power == 0 else math.expm1(power * size) / power, x)


def lambda_grid(low: float = LAMBDA_LOW, high: float = LAMBDA_HIGH, step: float = LAMBDA_STEP) -> list[float]:
    """Evenly spaced exponents, as exact decimals."""
    digits = max(0, -math.floor(math.log10(step)))
    return [round(low + i * step, digits + 1) for i in range(round((high - low) / step) + 1)]


def log_likelihood(
    values: DataFrame, exponents: Mapping[str, Sequence[float]], means: Mapping[str, float]
) -> DataFrame:
    """(column, lambda, n, mean, var, loglik) for all exponents of all columns in one pass.

    ``values`` is (column, value, w). Sums are taken around the transform of the
    column's mean, which keeps the variance of large numbers exact enough.
    """
    # Columns times exponents: a few hundred rows.
    grid = values.sparkSession.createDataFrame(
        [(c, lam, _yeo_johnson_number(means[c], lam)) for c, lams in exponents.items() for lam in lams],
        "column string, lambda double, anchor double",
    )
    x, w = F.col("value"), F.col("w")
    # Per value: the signed logarithm. Per value and exponent: one exponential.
    power = F.when(F.col("j") >= 0, F.col("lambda")).otherwise(2 - F.col("lambda"))
    grown = F.when(power == 0, F.abs("j")).otherwise(F.expm1(power * F.abs("j")) / power)
    t = F.signum("j") * grown - F.col("anchor")
    sums = (
        values.select("column", "w", (F.signum(x) * F.log1p(F.abs(x))).alias("j"))
        .join(F.broadcast(grid), "column")
        .select("column", "lambda", "anchor", "w", "j", t.alias("t"))
        .groupBy("column", "lambda", "anchor")
        .agg(
            F.sum("w").alias("n"),
            F.sum(w * F.col("t")).alias("s1"),
            F.sum(w * F.col("t") * F.col("t")).alias("s2"),
            F.sum(w * F.col("j")).alias("jacobian"),
        )
    )
    n = F.col("n")
    var = (F.col("s2") - F.col("s1") * F.col("s1") / n) / n
    return sums.select(
        "column", "lambda", "n",
        (F.col("anchor") + F.col("s1") / n).alias("mean"),
        var.alias("var"),
        (-n / 2 * F.log(var) + (F.col("lambda") - 1) * F.col("jacobian")).alias("loglik"),
    )


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str], refine: bool = True) -> dict[str, dict[str, float]]:
    """Per column the exponent of greatest likelihood, with mean and deviation of the transform.

    A grid finds the neighbourhood, moving on when the best exponent is at its
    end; finer grids and a parabola through the best three points follow.
    """
    ranges = ranges_of(df, columns)
    means = {c: row["mean"] for c, row in ranges.items()}
    values = weighted_values(df, ranges)

    def best(exponents: Mapping[str, Sequence[float]]) -> dict[str, list[Row]]:
        rows = log_likelihood(values, exponents, means).collect()
        return {
            c: sorted((r for r in rows if r["column"] == c and math.isfinite(r["loglik"] or math.nan)),
                      key=lambda r: r["lambda"])
            for c in exponents
        }

    def top(rows: list[Row]) -> Row:
        return max(rows, key=lambda r: (r["loglik"], -r["lambda"]))

    chosen: dict[str, Row] = {}
    search = {c: lambda_grid() for c in ranges}
    while search:
        scores = best(search)
        search = {}
        for c, rows in scores.items():
            if not rows:
                continue
            winner = top(rows)
            if c in chosen and winner["loglik"] <= chosen[c]["loglik"]:
                continue  # the best so far was not at an end after all
            chosen[c] = winner
            reach = LAMBDA_HIGH - LAMBDA_LOW
            if winner["lambda"] == rows[-1]["lambda"]:
                search[c] = lambda_grid(winner["lambda"], winner["lambda"] + reach)
            elif winner["lambda"] == rows[0]["lambda"]:
                search[c] = lambda_grid(winner["lambda"] - reach, winner["lambda"])

    for step in LAMBDA_REFINEMENTS if refine else ():
        scores = best({c: lambda_grid(r["lambda"] - 10 * step, r["lambda"] + 10 * step, step) for c, r in chosen.items()})
        chosen = {c: top(rows) for c, rows in scores.items()}
    if refine:
        vertex = {}
        for c, rows in scores.items():
            at = [r["lambda"] for r in rows].index(chosen[c]["lambda"])
            lam = chosen[c]["lambda"]
            if 0 < at < len(rows) - 1:
                a, b, d = (rows[at + i]["loglik"] for i in (-1, 0, 1))
                if a - 2 * b + d < 0:
                    lam += 0.5 * (a - d) / (a - 2 * b + d) * LAMBDA_REFINEMENTS[-1]
            vertex[c] = [lam]
        chosen = {c: rows[0] for c, rows in best(vertex).items()}
    return {
        c: {"lambda": r["lambda"], "mean": r["mean"], "std": math.sqrt(r["var"]) if r["var"] > 0 else 1.0}
        for c, r in chosen.items()
    }


def apply_yeo_johnson(df: DataFrame, fitted: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The fitted columns transformed and standardised, in one projection."""

    def scaled(c: str) -> Column:
        fit = fitted[c]
        t = yeo_johnson(F.col(c).cast("double"), F.lit(fit["lambda"]))
        return ((t - F.lit(fit["mean"])) / F.lit(fit["std"])).alias(c)

    return df.select(*[scaled(c) if c in fitted else F.col(c) for c in df.columns])


# --- ids ---


def _gap_summary(batches):
    """One row per partition of sorted ids: ends, count, and the gaps between neighbours."""
    first = last = None
    n, wide, least, most = 0, 0, None, None
    for batch in batches:
        ids = batch["id"].to_numpy()
        if not len(ids):
            continue
        if first is None:
            first = ids[0]
            gaps = np.diff(ids)
        else:
            gaps = np.diff(ids, prepend=last)
        if len(gaps):
            least = int(gaps.min()) if least is None else min(least, int(gaps.min()))
            most = int(gaps.max()) if most is None else max(most, int(gaps.max()))
            wide += int((gaps > 1).sum())
        n += len(ids)
        last = ids[-1]
    if n:
        yield pd.DataFrame(
            {"first": [first], "last": [last], "n": [n], "wide": [wide], "least": [least], "most": [most]}
        ).astype({"least": "Int64", "most": "Int64"})


def id_density(df: DataFrame, column: str) -> DataFrame:
    """How whole-number ids spread: count, ends, missing ids, and the gaps between neighbours.

    The distinct ids are sorted by range, each partition is summed up where it
    is, and only the ends of the partitions are compared with each other.
    """
    ship_package(df.sparkSession)
    ids = df.select(F.col(column).cast("bigint").alias("id")).where(F.col("id").isNotNull()).distinct()
    parts = ids.orderBy("id").mapInPandas(
        _gap_summary, "first long, last long, n long, wide long, least long, most long"
    )
    # One row per partition.
    seam = F.col("first") - F.lag("last").over(Window.orderBy("first"))
    return (
        parts.withColumn("seam", seam)
        .agg(
            F.sum("n").alias("n_ids"),
            F.min("first").alias("min_id"),
            F.max("last").alias("max_id"),
            F.least(F.min("least"), F.min("seam")).alias("min_gap"),
            F.greatest(F.max("most"), F.max("seam")).alias("max_gap"),
            (F.sum("wide") + F.count_if(F.col("seam") > 1)).alias("n_gaps"),
        )
        .withColumn("n_missing", F.col("max_id") - F.col("min_id") + 1 - F.col("n_ids"))
        .withColumn(
            "mean_gap",
            F.when(F.col("n_ids") > 1, (F.col("max_id") - F.col("min_id")) / (F.col("n_ids") - 1)),
        )
    )
