from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from courtside.functions import text as fx


def values(spark, function, cells, schema="v string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, {schema}")
    return [r[0] for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_heights(spark):
    cells = ["6-10", "6", "", None, "a-b", "6-10-1", "7-0"]
    assert values(spark, fx.height_to_inches, cells) == [82, None, None, None, None, None, 84]


@pytest.mark.parametrize("side, expected", [(0, [102, 102, None, None]), (1, [99, None, 1, None])])
def test_scores(spark, side, expected):
    assert values(spark, lambda c: fx.score_part(c, side), ["102 - 99", "102", "x - 1", None]) == expected


def test_mixed_numbers(spark):
    cells = ["12", " 1.5e3 ", "$123.45", "3 units", "abc", "", None, "12.", "-4", "a-7b8"]
    expected = [12.0, 1500.0, 123.45, 3.0, None, None, None, 12.0, -4.0, -7.0]
    assert values(spark, fx.string_to_number, cells) == expected


def test_only_plain_numbers_are_numbers(spark):
    cells = ["1d", "0x1p3", "NaN", "inf", "12.", ".5", "1e3", " 7 ", "1 2", "-"]
    assert values(spark, fx.to_double, cells) == [None, None, None, None, 12.0, 0.5, 1000.0, 7.0, None, None]


def test_whole_numbers(spark):
    assert values(spark, fx.to_bigint, ["12", "12.0", " 3 ", "9223372036854775808", "x"]) == [12, None, 3, None, None]


def test_arrays(spark):
    cells = [["x", "2.5"], ["x"], [], None, [None, "4"]]
    assert values(spark, fx.first_numeric_in_array, cells, "v array<string>") == [2.5, None, None, None, 4.0]


def test_json(spark):
    cells = ['{"value":"3"}', '{"amount":"4"}', '{"count":5}', "7", "bad", '{"value":"x","count":2}']
    assert values(spark, fx.json_number, cells) == [3.0, 4.0, 5.0, 7.0, None, 2.0]


def test_leading_integers(spark):
    assert values(spark, fx.leading_integer, ["12ab", "ab", "-3", " 4.9", "", None]) == [12, 0, -3, 4, 0, None]


def test_sentinels_and_missing_texts(spark):
    assert values(spark, fx.sentinel_to_null, ["None", "nan", "", "x", None]) == [None, None, None, "x", None]
    assert values(spark, fx.csv_value, ["NA", "NULL", "0", "none", None]) == [None, None, "0", "none", None]


def test_bytes_that_are_no_text_are_dropped(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "b binary")
    assert df.select(fx.utf8_clean(F.col("b").cast("string"))).first()[0] == "abc"
