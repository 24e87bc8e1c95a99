"""Text to number, height, score and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.constants import CSV_MISSING, NUMERIC_PART, NUMERIC_TEXT, SENTINEL_TEXTS

# The patterns keep out the hex and suffixed forms ("0x1p3", "1d") that a JVM
# parse would take, and they are cheap: a cast that fails costs an exception.
_WHOLE_NUMBER = r"^\s*[-+]?[0-9]+\s*$"
_PLAIN_NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


def _found(text: Column, pattern: str, group: int) -> Column:
    """What a pattern finds in a text; NULL, not '', where it finds nothing.

    Going through an array runs the pattern once; ``nullif`` would run it twice.
    """
    found = F.array(F.regexp_extract(text, pattern, group))
    return F.get(F.filter(found, lambda part: part != ""), F.lit(0))


def to_double(text: Column) -> Column:
    """The number a text spells, NULL for anything else."""
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def to_bigint(text: Column) -> Column:
    """The whole number a text spells, NULL for anything else, also for '3.0'."""
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint"))


def to_integer(text: Column) -> Column:
    """As :func:`to_bigint`, for 32 bits."""
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("int"))


def csv_value(text: Column) -> Column:
    """A CSV cell with the missing-value texts as NULL."""
    return F.when(~text.isin(*CSV_MISSING), text)


def sentinel_to_null(text: Column) -> Column:
    """A consolidated text with 'None', 'nan' and '' as NULL."""
    return F.when(~text.isin(*SENTINEL_TEXTS), text)


def utf8_clean(text: Column) -> Column:
    """The text without the characters that cannot be encoded."""
    return F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit(""))


def height_to_inches(height: Column) -> Column:
    """'6-10' -> 82; NULL unless there are exactly two whole numbers."""
    parts = F.split(F.coalesce(height, F.lit("")), "-")
    feet = to_integer(F.try_element_at(parts, F.lit(1)))
    inches = to_integer(F.try_element_at(parts, F.lit(2)))
    return F.when(F.size(parts) == 2, feet * 12 + inches)


def score_part(score: Column, position: int) -> Column:
    """Side ``position`` (0 home, 1 away) of a running score like '102 - 99'."""
    return to_integer(F.get(F.split(score, " - "), F.lit(position)))


def string_to_number(text: Column) -> Column:
    """The text as a number, else the first number found in it, else NULL."""
    return (
        F.when(F.length(text) == 0, None)
        .when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))
        .otherwise(_found(text, NUMERIC_PART, 0).try_cast("double"))
    )


def first_numeric_in_array(values: Column) -> Column:
    """The first element that is a number."""
    numbers = F.transform(values, lambda v: to_double(v.cast("string")))
    return F.get(F.filter(numbers, lambda n: n.isNotNull()), F.lit(0))


def json_number(text: Column) -> Column:
    """The first number among the keys value, amount and count, else the text itself."""
    keyed = [to_double(F.get_json_object(text, f"$.{key}")) for key in ("value", "amount", "count")]
    return F.coalesce(*keyed, to_double(text))


def leading_integer(text: Column) -> Column:
    """Leading digits of a text as a whole number, 0 when there are none; NULL stays."""
    digits = _found(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")
    return F.when(text.isNotNull(), F.coalesce(digits, F.lit(0)))


def to_timestamp(text: Column) -> Column:
    """The timestamp a text spells, NULL for anything else."""
    return text.try_cast("timestamp_ntz")


def is_finite(number: Column) -> Column:
    """True for numbers other than NaN and the infinities; NULL gives NULL."""
    return ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def nan_to_null(number: Column) -> Column:
    """NaN as NULL."""
    return F.when(~F.isnan(number), number)
