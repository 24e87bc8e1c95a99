"""Column profiles: counts, ranges, distinct values, keys, parse counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions.text import (
    csv_value,
    first_numeric_in_array,
    is_finite,
    json_number,
    leading_integer,
    string_to_number,
    to_bigint,
    to_double,
    to_timestamp,
)

# Whole numbers are counted as bits where a value has no more than so many bits
# of the column's range: 64 are the size of the value itself.
BITS_PER_VALUE = 64

# Squares of numbers beyond LARGE come near the largest double: they are made
# SCALE times as large, a power of two, which rounds nothing.
LARGE, SCALE = 1e100, 2.0**-600


def _field(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def _in_table_order(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(df.columns if columns is None else columns)


def _temporal(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def numeric_value(df: DataFrame, column: str, json: bool = False) -> Column:
    """The number a cell stands for, by the type of its column; NULL if none."""
    data_type, value = _field(df, column), F.col(column)
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if _temporal(data_type):
        return F.unix_micros(value.cast("timestamp")) / F.lit(1e6)
    if isinstance(data_type, T.ArrayType):
        return first_numeric_in_array(value)
    if isinstance(data_type, T.StringType):
        return json_number(value) if json else string_to_number(value)
    return to_double(value.cast("string"))


def column_statistics(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    json_columns: Sequence[str] = (),
    sample_rows: int | None = None,
    keep_overflow: bool = False,
) -> DataFrame:
    """(column, n, min, max, mean, population std) of the finite numbers of each column.

    Columns without a number are left out, and so are those whose sum, or sum of
    squares about the mean, overflows; with ``keep_overflow`` they stay, and that
    statistic is infinite. Dates have a range in seconds but no mean. ``sample_rows``
    takes so many values per column instead of all of them.
    """
    columns = _in_table_order(df, columns)
    values = df.select(*[numeric_value(df, c, c in json_columns).alias(c) for c in columns])
    if sample_rows is None:
        long = values.unpivot([], columns, "column", "value")
    else:
        long = reduce(
            DataFrame.unionByName,
            [
                values.select(F.lit(c).alias("column"), F.col(c).alias("value")).where(F.col(c).isNotNull())
                .limit(sample_rows)
                for c in columns
            ],
        )
    dates = [c for c in columns if _temporal(_field(df, c))]
    undated = ~F.col("column").isin(*dates) if dates else F.lit(True)
    grouped = (
        long.where(F.col("value").isNotNull() & is_finite(F.col("value")))
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            (F.stddev_pop(F.col("value") * SCALE) / SCALE).alias("std_large"),
        )
    )
    # Partial results of large numbers merge to NaN, so their deviation is that of the scaled ones.
    std = F.when(F.greatest(F.abs("min"), F.abs("max")) <= LARGE, F.col("std")).otherwise(
        F.when(is_finite(F.col("std_large") * F.col("std_large") * F.col("n")), F.col("std_large")).otherwise(F.lit(float("inf")))
    )
    grouped = grouped.withColumn("std", std).drop("std_large")
    if not keep_overflow:
        grouped = grouped.where(is_finite(F.col("mean")) & is_finite(F.col("std")))
    return grouped.withColumns(
        {name: F.when(undated, F.col(name)) for name in ("mean", "std")}
    )


def id_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, min, max) of the columns named like an id, or of those given.

    Text is read by its leading digits, NaN does not count, and a column
    without values has no row. Ranges are whole numbers, and doubles only if
    one of the columns is not whole.
    """
    columns = [c for c in df.columns if "id" in c.lower()] if columns is None else list(columns)
    values = []
    broken = {c for c in columns if isinstance(_field(df, c), (T.FractionalType, T.DecimalType))}
    for c in columns:
        is_text = isinstance(_field(df, c), T.StringType)
        name = f"`{c}`"
        whole = leading_integer(F.col(name)) if is_text else F.col(name).cast("bigint")
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) if c in broken else whole
        values.append((number.cast("double") if broken else number).alias(c))
    long = df.select(*values).unpivot([], [f"`{c}`" for c in columns], "column", "value")
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.min("value").alias("min"), F.max("value").alias("max"))
    )


def _whole(df: DataFrame, column: str) -> Column | None:
    """A column as 64-bit whole numbers that differ where its values do; None for other types."""
    data_type, value = _field(df, column), F.col(f"`{column}`")
    if isinstance(data_type, (T.IntegralType, T.BooleanType)):
        return value.cast("bigint")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value)
    return None


def _as_key(df: DataFrame, column: str) -> Column:
    """(whole, number, text) that differ where the values of a column of any type do."""
    data_type, value, whole = _field(df, column), F.col(f"`{column}`"), _whole(df, column)
    number = text = F.lit(None)
    if whole is not None:
        pass
    elif isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        number = value
    elif isinstance(data_type, T.BinaryType):
        text = F.hex(value)
    elif isinstance(data_type, (T.ArrayType, T.StructType)):
        text = F.when(value.isNotNull(), F.to_json(F.array(value)))
    else:
        text = value
    whole = F.lit(None) if whole is None else whole
    return F.struct(whole.cast("bigint").alias("whole"), number.cast("double").alias("number"), text.cast("string").alias("text"))


def _bitmap_counts(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(place, n_distinct) of columns of whole numbers: a bit per value, 32,768 to a bitmap."""
    cells = [
        F.struct(F.lit(i).alias("place"), F.bitmap_bucket_number(_whole(df, c)).alias("bucket"), F.bitmap_bit_position(_whole(df, c)).alias("bit"))
        for i, c in columns.items()
    ]
    bitmaps = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("bucket").isNotNull())
        .groupBy("place", "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    return bitmaps.groupBy("place").agg(F.sum(F.bitmap_count("bitmap")).alias("n_distinct"))


def _value_counts(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(place, n_distinct) of columns of any type: values are made unique in each task, then by column and value."""
    cells = [F.struct(F.lit(i).alias("place"), _as_key(df, c).alias("key")) for i, c in columns.items()]
    keys = df.select(F.inline(F.array(*cells))).select("place", "key.whole", "key.number", "key.text")
    there = F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull()
    return keys.where(there).distinct().groupBy("place").agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column, n_rows, n_nonnull, n_distinct) per column.

    A first pass takes counts and ranges. Columns of whole numbers, dates and
    times whose range is not much wider than their rows are counted as bits of
    bitmaps, of which a task passes on one per 32,768 values; values of other
    columns are made unique before they are counted. Arrays and structs are
    told apart by their JSON form.
    """
    columns = _in_table_order(df, columns)
    named = [f"`{c}`" for c in columns]
    if approximate:
        totals = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(f"_nonnull_{i}") for i, c in enumerate(named)],
            *[F.approx_count_distinct(c).alias(f"_distinct_{i}") for i, c in enumerate(named)],
        )
        told = [F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_nonnull_{i}").alias("n_nonnull"),
                         F.col(f"_distinct_{i}").alias("n_distinct")) for i, c in enumerate(columns)]
        return totals.select(F.inline(F.array(*told)))

    whole = {i: c for i, c in enumerate(columns) if _whole(df, c) is not None}
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(named)],
        *[f(_whole(df, c)).alias(f"{side}_{i}") for i, c in whole.items() for side, f in (("low", F.min), ("high", F.max))],
    ).first()
    dense = {i: c for i, c in whole.items() if row[f"n_{i}"] and row[f"high_{i}"] - row[f"low_{i}"] < BITS_PER_VALUE * row[f"n_{i}"]}
    other = {i: c for i, c in enumerate(columns) if i not in dense and row[f"n_{i}"]}
    known = df.sparkSession.createDataFrame([(i, c, row["n"], row[f"n_{i}"]) for i, c in enumerate(columns)], "place int, column string, n_rows long, n_nonnull long")
    counted = [count(df, of) for count, of in ((_bitmap_counts, dense), (_value_counts, other)) if of]
    if not counted:
        return known.select("column", "n_rows", "n_nonnull", F.lit(0).cast("long").alias("n_distinct"))
    # One row per column on both sides.
    found = known.join(reduce(DataFrame.unionByName, counted), "place", "left")
    return found.select("column", "n_rows", "n_nonnull", F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))


def candidate_keys(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`distinct_counts` with ``is_key``: every row has a value of its own.

    An empty table has no keys.
    """
    total = F.col("n_rows")
    return distinct_counts(df, columns).withColumn(
        "is_key", (total > 0) & (total == F.col("n_distinct")) & (total == F.col("n_nonnull"))
    )


def key_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The key columns only, with exact distinct counts just where they can matter.

    One pass over counts and ranges rules out columns with nulls, and whole
    numbers whose range is smaller than the row count.
    """
    columns = _in_table_order(df, columns)
    whole = [c for c in columns if isinstance(_field(df, c), T.IntegralType)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[(F.max(c).cast("decimal(20,0)") - F.min(c) + 1).alias(f"reach_{columns.index(c)}") for c in whole],
    ).first()
    if row["n"] == 0:
        return []
    left = [
        c
        for i, c in enumerate(columns)
        if row[f"n_{i}"] == row["n"] and (c not in whole or row[f"reach_{i}"] >= row["n"])
    ]
    if not left:
        return []
    keys = {r["column"] for r in candidate_keys(df, left).where("is_key").collect()}
    return [c for c in columns if c in keys]


def few_values(df: DataFrame, column: str, at_most: int) -> bool:
    """True when a column has at most so many distinct values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().limit(at_most + 1).count() <= at_most


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the form a CSV file has it in."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def text_profile(df: DataFrame) -> DataFrame:
    """What the cells of each text column parse as, in one aggregation over all rows.

    Missing-value texts count as NULL. Columns: position, column, n_rows, n_null,
    n_bool, n_int, min_int, max_int, n_double, n_integral, max_abs, n_timestamp,
    max_len.
    """
    # One row per column, from the schema; a column of an empty table is there with zeros.
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "position int, column string")
    cells = (
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), csv_value(F.col(f"`{c}`")).alias("text")) for c in df.columns])))
        .withColumn("whole", to_bigint(F.col("text")))
        .withColumn("number", to_double(F.col("text")))
    )
    text = F.col("text")
    profile = cells.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(text.isNull()).alias("n_null"),
        F.count_if(F.lower(text).isin("true", "false")).alias("n_bool"),
        F.count("whole").alias("n_int"),
        F.min("whole").alias("min_int"),
        F.max("whole").alias("max_int"),
        F.count("number").alias("n_double"),
        F.count_if(F.col("number") == F.floor("number")).alias("n_integral"),
        F.max(F.abs("number")).alias("max_abs"),
        F.count(F.when(F.col("number").isNull(), to_timestamp(text))).alias("n_timestamp"),
        F.coalesce(F.max(F.length(text)), F.lit(0)).alias("max_len"),
    )
    counts = [c for c in profile.columns if c.startswith("n_") or c == "max_len"]
    found = F.broadcast(names).join(profile, "column", "left").na.fill(0, counts)
    return found.select("position", *profile.columns)


def mixed_type_report(df: DataFrame) -> DataFrame:
    """Text columns whose values read as more than one kind, with the count of each kind.

    Kinds, first fit: whole number, number, boolean, timestamp, other text.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    text = F.col("text")
    kind = (
        F.when(to_bigint(text).isNotNull(), "int")
        .when(to_double(text).isNotNull(), "double")
        .when(F.lower(text).isin("true", "false"), "bool")
        .when(to_timestamp(text).isNotNull(), "timestamp")
        .otherwise("other")
    )
    kinds = ("int", "double", "bool", "timestamp", "other")
    counts = (
        df.select(*columns)
        .unpivot([], columns, "column", "text")
        .where(text.isNotNull())
        .withColumn("kind", kind)
        .groupBy("column")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])
    )
    present = sum((F.col(f"n_{k}") > 0).cast("int") for k in kinds)
    return counts.withColumn("n_kinds", present).where(F.col("n_kinds") > 1)
