"""Column types from text profiles, and the type lattices of three kinds of store.

A profile row comes from :func:`courtside.operators.profile.text_profile`. The
profile is taken over all rows by a distributed aggregation; the functions here
turn its one row per column into a type and never see the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.constants import (
    FLOAT32_LIMIT,
    FORCED_STRING_COLUMNS,
    MAX_VARCHAR,
    MIN_VARCHAR,
    ROWSTORE_TO_COLUMNSTORE,
    WAREHOUSE_TO_COLUMNSTORE,
)
from courtside.functions.text import to_timestamp
from courtside.operators.profile import text_profile


def kind(profile: Row, forced_strings: Sequence[str] = FORCED_STRING_COLUMNS, parse_dates: bool = False) -> str:
    """boolean, integer, float, timestamp, string or empty: what all values of a column are."""
    n = profile["n_rows"] - profile["n_null"]
    if profile["column"] in forced_strings:
        return "string"
    if n == 0:
        return "empty"
    if profile["n_bool"] == n:
        return "boolean"
    if profile["n_int"] == n:
        return "integer"
    if profile["n_double"] == n:
        return "integer" if profile["n_integral"] == n and profile["max_abs"] < 2.0**63 else "float"
    if parse_dates and profile["n_timestamp"] == n:
        return "timestamp"
    return "string"


def _reach(profile: Row) -> tuple[float, float]:
    """Smallest and largest whole number; floats like 3.0 are covered by the largest size."""
    if profile["n_int"] == profile["n_rows"] - profile["n_null"]:
        return profile["min_int"], profile["max_int"]
    return -profile["max_abs"], profile["max_abs"]


def _fits(profile: Row, bits: int) -> bool:
    low, high = _reach(profile)
    return -(2 ** (bits - 1)) <= low and high <= 2 ** (bits - 1) - 1


def columnstore_type(profile: Row, **options) -> str:
    """The narrowest column-store type: Int8 to Int64, Float32 or Float64, text by length."""
    what = kind(profile, **options)
    if what == "integer":
        return next((f"Int{bits}" for bits in (8, 16, 32) if _fits(profile, bits)), "Int64")
    if what == "float":
        return "Float32" if profile["max_abs"] < FLOAT32_LIMIT else "Float64"
    if what == "string":
        n = profile["max_len"]
        return f"FixedString({n})" if n <= MAX_VARCHAR else "String"
    return {"boolean": "UInt8", "timestamp": "DateTime", "empty": "Int64"}[what]


def rowstore_type(profile: Row, **options) -> str:
    """The row-store type: SMALLINT to BIGINT, REAL or DOUBLE, VARCHAR by length or TEXT."""
    what = kind(profile, **options)
    if what == "integer":
        names = {16: "SMALLINT", 32: "INTEGER"}
        return next((name for bits, name in names.items() if _fits(profile, bits)), "BIGINT")
    if what == "float":
        return "REAL" if profile["max_abs"] < FLOAT32_LIMIT else "DOUBLE PRECISION"
    if what == "string":
        n = profile["max_len"] or MIN_VARCHAR
        return f"VARCHAR({n})" if n <= MAX_VARCHAR else "TEXT"
    return {"boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "empty": "INTEGER"}[what]


def warehouse_type(profile: Row, **options) -> str:
    """The warehouse type: INT64, FLOAT64, BOOL, DATETIME or STRING."""
    what = kind(profile, **options)
    names = {
        "integer": "INT64",
        "float": "FLOAT64",
        "boolean": "BOOL",
        "timestamp": "DATETIME",
        "empty": "INT64",
        "string": "STRING",
    }
    return names[what]


LADDERS = {"columnstore": columnstore_type, "rowstore": rowstore_type, "warehouse": warehouse_type}


def is_nullable(profile: Row) -> bool:
    """True when a column has a missing value anywhere."""
    return profile["n_null"] > 0


def profile_rows(df: DataFrame) -> list[Row]:
    """The text profile in column order: one row per column, so it fits the driver."""
    return sorted(text_profile(df).collect(), key=lambda row: row["position"])


def infer_types(df: DataFrame, ladder: str, **options) -> DataFrame:
    """(position, column, inferred_type, nullable) of text columns for one kind of store."""
    rows = [
        (row["position"], row["column"], LADDERS[ladder](row, **options), is_nullable(row))
        for row in profile_rows(df)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, inferred_type string, nullable boolean"
    )


_SPARK = {
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.BooleanType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "DateTime": T.TimestampNTZType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "REAL": T.FloatType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "DATETIME": T.TimestampNTZType(),
}


def spark_schema(profiles: Sequence[Row], ladder: str, **options) -> T.StructType:
    """The schema a load casts to; text keeps its greatest length as metadata."""
    fields = []
    for row in profiles:
        name = LADDERS[ladder](row, **options)
        data_type = spark_type(name)
        metadata = {"max_len": row["max_len"]} if isinstance(data_type, T.StringType) else {}
        fields.append(T.StructField(row["column"], data_type, is_nullable(row), metadata))
    return T.StructType(fields)


def spark_type(name: str) -> T.DataType:
    """The type a cell is cast to for a type of any of the ladders; text for what is not a number, truth value or time."""
    return _SPARK.get(name, T.StringType())


# --- lattices: types of parts of a column merge into the type of the column ---

_LOADED_ORDER = ("boolean", "Int64", "Float64")


def merge_loaded(left: str, right: str) -> str:
    """Merge of loaded types: equal stays, numbers widen, anything else is text."""
    if left == right:
        return left
    if left in _LOADED_ORDER and right in _LOADED_ORDER:
        wider = max(left, right, key=_LOADED_ORDER.index)
        return wider
    return "string"


def merge_warehouse(left: str, right: str) -> str:
    """Merge of warehouse types: equal stays, numbers become FLOAT64, anything else is STRING."""
    if left == right:
        return left
    return "FLOAT64" if {left, right} == {"INT64", "FLOAT64"} else "STRING"


_WHOLE = ("SMALLINT", "INTEGER", "BIGINT")


def _varchar_length(name: str) -> int:
    return int(name[len("VARCHAR(") : -1])


def merge_rowstore(left: str, right: str) -> str:
    """Merge of row-store types to the narrowest type that holds both.

    Texts keep the greater length, and TEXT once that passes the limit; types of
    different families become TEXT.
    """
    if left == right:
        return left
    if left.startswith("VARCHAR") and right.startswith("VARCHAR"):
        n = max(_varchar_length(left), _varchar_length(right))
        return f"VARCHAR({n})" if n <= MAX_VARCHAR else "TEXT"
    pair = {left, right}
    if pair <= set(_WHOLE):
        return max(left, right, key=_WHOLE.index)
    if pair <= {*_WHOLE, "REAL", "DOUBLE PRECISION"}:
        return "REAL" if pair == {"SMALLINT", "REAL"} else "DOUBLE PRECISION"
    return "TEXT"


def render_rowstore(name: str) -> str:
    """A merged type as it is declared: a VARCHAR has at least the smallest length."""
    if name.startswith("VARCHAR"):
        return f"VARCHAR({max(_varchar_length(name), MIN_VARCHAR)})"
    return name


def merge_schemas(schemas: Sequence[Mapping[str, str]], merge=merge_rowstore) -> dict[str, str]:
    """Column types of several parts of one table, merged per column."""
    names = dict.fromkeys(c for schema in schemas for c in schema)
    return {c: reduce(merge, [s[c] for s in schemas if c in s]) for c in names}


# --- schema translation between stores ---


def map_source_type(name: str, source: str) -> str:
    """The column-store type of a source type: exact name, then a name it contains, then String."""
    table = ROWSTORE_TO_COLUMNSTORE if source == "rowstore" else WAREHOUSE_TO_COLUMNSTORE
    lookup = {key.lower(): value for key, value in table.items()}
    name = name.lower()
    if name in lookup:
        return lookup[name]
    inside = [key for key in lookup if key in name]
    return lookup[max(inside, key=len)] if inside else "String"


def dates_by_name(df: DataFrame) -> list[str]:
    """Text columns named like a date or time whose every value parses as one.

    A column without values counts, as there is nothing in it that fails.
    """
    named = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and any(part in f.name.lower() for part in ("date", "time"))
    ]
    if not named:
        return []
    bad = df.agg(
        *[F.count_if(F.col(c).isNotNull() & to_timestamp(F.col(c)).isNull()).alias(c) for c in named]
    ).first()
    return [c for c in named if bad[c] == 0]


def consolidated_schema(df: DataFrame, dates: Sequence[str] = ()) -> T.StructType:
    """Every column nullable and of one of four kinds: double, long, timestamp, text."""

    def target(field: T.StructField) -> T.DataType:
        if field.name in dates or isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return T.TimestampNTZType()
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(field.dataType, T.DecimalType):
            return field.dataType
        if isinstance(field.dataType, T.IntegralType):
            return T.LongType()
        return T.StringType()

    return T.StructType([T.StructField(f.name, target(f), True) for f in df.schema.fields])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; a cell that does not fit is NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])


def render_ddl(types: Sequence[tuple[str, str, bool]], store: str) -> str:
    """A column definition list from (name, type, nullable), in the quoting of the store."""
    if store == "columnstore":
        return ", ".join(f"`{c}` Nullable({t})" if nullable else f"`{c}` {t}" for c, t, nullable in types)
    if store == "rowstore":
        return ", ".join(f'"{c}" {render_rowstore(t)}' for c, t, _ in types)
    return ", ".join(f"{c} {t}" + ("" if nullable else " NOT NULL") for c, t, nullable in types)
