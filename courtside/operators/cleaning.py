"""Cleaning: missing values, text repair, coercion, and dropping of columns and rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.constants import FORCED_STRING_COLUMNS
from courtside.functions import text as fx


def _replace(df: DataFrame, kinds: tuple[type, ...], change) -> DataFrame:
    """``change`` applied to every column of the given types, in one projection."""
    return df.select(
        *[
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def quoted(column: str) -> str:
    """A column name as one name, whatever is in it."""
    return "`" + column.replace("`", "``") + "`"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as NULL in every float column."""
    return _replace(df, (T.FloatType, T.DoubleType), fx.nan_to_null)


def sentinels_to_null(df: DataFrame) -> DataFrame:
    """'None', 'nan' and '' as NULL in every text column."""
    return _replace(df, (T.StringType,), fx.sentinel_to_null)


def clean_utf8(df: DataFrame) -> DataFrame:
    """Text columns without the characters that cannot be encoded."""
    return _replace(df, (T.StringType,), fx.utf8_clean)


def clean_for_load(df: DataFrame) -> DataFrame:
    """The cleaning every consolidated table gets."""
    return clean_utf8(sentinels_to_null(nan_to_null(df)))


def _number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return fx.to_double(F.col(column))
    return F.col(column).try_cast("double")


def coerce_numeric(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The named columns that are present, or all, as numbers; what does not parse is NULL."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[_number(df, c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def to_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns that are present as text; NULL stays NULL."""
    wanted = set(columns)
    return df.select(*[F.col(c).cast("string").alias(c) if c in wanted else F.col(c) for c in df.columns])


def _value(df: DataFrame, column: str) -> Column:
    """A column with NaN, which is no value, as NULL."""
    value = F.col(quoted(column))
    return fx.nan_to_null(value) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else value


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nothing but NULL and NaN; one aggregation decides."""
    counts = df.agg(*[F.count(_value(df, c)).alias(f"n_{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if counts[i] > 0])


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Without the rows that have a NULL (or NaN) in any of the columns."""
    return df.na.drop("any", subset=None if columns is None else list(columns))


def varying_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with more than one distinct value, NULL and NaN aside.

    That is where the smallest and the largest value differ, which needs no
    distinct count.
    """
    columns = list(df.columns if columns is None else columns)
    row = df.agg(*[(F.min(_value(df, c)) != F.max(_value(df, c))).alias(f"v_{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[i]]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Without the columns that have fewer than two distinct values."""
    return df.select(*[quoted(c) for c in varying_columns(df)])


def demote_integral(df: DataFrame, forced_strings: Sequence[str] = FORCED_STRING_COLUMNS) -> DataFrame:
    """Float and text columns as whole numbers where every value is one.

    Columns without values, and those always loaded as text, stay as they are.
    """
    candidates = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.StringType)) and f.name not in forced_strings
    ]
    if not candidates:
        return df

    def fits(c: str) -> Column:
        number = _number(df, c)
        whole = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**63))
        missing = F.col(c).isNull()
        if not isinstance(df.schema[c].dataType, T.StringType):
            missing = missing | F.isnan(c)
        return F.bool_and(F.when(~missing, F.coalesce(whole, F.lit(False)))).alias(c)

    row = df.agg(*[fits(c) for c in candidates]).first()
    return df.select(
        *[
            F.coalesce(fx.to_bigint(F.col(c)), _number(df, c).try_cast("bigint")).alias(c)
            if c in candidates and row[c] and isinstance(df.schema[c].dataType, T.StringType)
            else F.col(c).try_cast("bigint").alias(c)
            if c in candidates and row[c]
            else F.col(c)
            for c in df.columns
        ]
    )


def fill_null(df: DataFrame, value=0) -> DataFrame:
    """NULL as ``value`` in every column it fits."""
    return df.na.fill(value)


def drop_and_rename(df: DataFrame, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Without the named columns, and with new names for others."""
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def add_constant(df: DataFrame, column: str, value) -> DataFrame:
    """With a column that says the same in every row."""
    return df.withColumn(column, F.lit(value))
