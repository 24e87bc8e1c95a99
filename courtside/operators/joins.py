"""Joins: dimension lookups, fan-outs, stars over a shared column, semi joins.

Join strategy is left to Catalyst and the adaptive planner, which knows the
real sizes and splits a skewed partition of either side of an inner join and of
the left side of a left join. Two things it does not do are done here: rows
whose key is NULL, which match nothing but hash to one partition, are spread;
and a left join to a table in which one key may hold very many rows runs as an
inner join plus the rows without a match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Over how many partitions the rows without a key are spread.
NULL_KEY_SPREAD = 1024

# Most copies of a row that one array of copies stands for.
COPIES_PER_PIECE = 100_000


def _spread_keys(left: DataFrame, right: DataFrame, key: str, right_key: str) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a second join key that spreads the left rows without a first one.

    It is 0 for every row that can match and 1 to ``NULL_KEY_SPREAD`` for the
    others, so these are hashed apart. On the right it is written as a
    remainder, as a plain 0 would be folded out of the keys.
    """
    spread = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*left.columns), F.lit(NULL_KEY_SPREAD)) + 1
    ).otherwise(F.lit(0).cast("bigint"))
    keyed_left = left.withColumn("_spread", spread)
    keyed_right = right.withColumnRenamed(right_key, "_key").withColumn(
        "_zero", F.pmod(F.xxhash64("_key"), F.lit(1).cast("bigint"))
    )
    return keyed_left, keyed_right, (F.col(key) == F.col("_key")) & (F.col("_spread") == F.col("_zero"))


def left_lookup(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Left join to a dimension on one key; rows with a NULL key are kept, and spread.

    The right key column is not in the result.
    """
    keyed_left, keyed_right, on = _spread_keys(left, right, key, right_key or key)
    return keyed_left.join(keyed_right, on, "left").drop("_key", "_spread", "_zero")


def left_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table with many rows per key, one key perhaps with most of them.

    A left join cannot split the right side of one key over several tasks, an
    inner join can; the rows without a match come from an anti join against the
    distinct keys, which are merged before they are shuffled.
    """
    matched = left.join(right, key)
    keyed_left, keyed_right, on = _spread_keys(left, right.select(key).distinct(), key, key)
    unmatched = keyed_left.join(keyed_right, on, "left_anti").drop("_spread")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def with_copies(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that adds no column, only repeats rows: the repeats are counted first.

    Adds ``_copies``, to be spelled out with :func:`spell_out_copies` once the
    later joins are done. A key with very many right rows becomes several rows
    of at most ``COPIES_PER_PIECE`` copies, so that no array grows with the data.
    """
    size = F.lit(COPIES_PER_PIECE)
    counts = right.groupBy(F.col(key).alias("_counted")).agg(F.count(F.lit(1)).alias("_n"))
    pieces = counts.select(
        "_counted", "_n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / size) - 1)).alias("_piece")
    ).select("_counted", F.least(size, F.col("_n") - F.col("_piece") * size).cast("int").alias("_copies"))
    return left_lookup(left, pieces, key, "_counted")


def spell_out_copies(df: DataFrame) -> DataFrame:
    """Each row as often as ``_copies`` says, once where that is NULL."""
    times = F.sequence(F.lit(1), F.coalesce(F.col("_copies"), F.lit(1)))
    return df.withColumn("_copy", F.explode(times)).drop("_copies", "_copy")


def prefixed(df: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns as ``<table>__<column>``, but for those in ``keep``."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(f"{table}__{c}") for c in df.columns])


def table_names(entry) -> list[str]:
    """Table names of one common-columns entry.

    Takes a plain list of names, or the document form
    ``{"tables": [{"name": ...}, ...]}``.
    """
    if isinstance(entry, Mapping):
        entry = entry["tables"]
    return [item["name"] if isinstance(item, Mapping) else item for item in entry]


def star_join_size(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """One row, (n_keys, n_rows): how many keys all tables share, and how many rows their star join has.

    Exact, from the product of each key's counts: what is joined is one row per
    key and table, so keys that repeat cost no more than others. Both are 0 if
    no key is shared; a NULL key joins nothing.
    """
    joined = None
    for df in tables.values():
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n"))
        if joined is None:
            joined = counts
        else:
            joined = joined.join(counts.withColumnRenamed("n", "m"), column).select(
                column, (F.col("n") * F.col("m")).cast("decimal(38,0)").alias("n")
            )
    return joined.agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0).cast("decimal(38,0)")).alias("n_rows"))


def star_join(tables: Mapping[str, DataFrame], column: str, max_rows: int | None = None) -> DataFrame | None:
    """Inner join of every table to the first on ``column``; None for fewer than two.

    ``column`` comes out once, every other column as ``<table>__<column>``. A
    column that repeats in several tables multiplies them: with ``max_rows`` the
    size is counted first, and a join beyond it is an error that tells its size.
    """
    if len(tables) < 2:
        return None
    if max_rows is not None:
        size = int(star_join_size(tables, column).first()["n_rows"])
        if size > max_rows:
            raise ValueError(f"{column}: the join of {', '.join(tables)} has {size} rows, more than {max_rows}")
    frames = [prefixed(df, name, keep=[column]) for name, df in tables.items()]
    joined = frames[0]
    for frame in frames[1:]:
        joined = joined.join(frame, column, "inner")
    return joined


def star_joins(common_columns: Mapping[str, object], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One :func:`star_join` per common column that at least two tables have."""
    joins = {}
    for column, entry in common_columns.items():
        joined = star_join({name: tables[name] for name in table_names(entry)}, column)
        if joined is not None:
            joins[column] = joined
    return joins


def keep_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is among ``ids``."""
    return df.join(ids.select(column), column, "left_semi")
