from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from courtside.operators import catalog, cleaning, profile


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_keys_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [r["is_key"] for r in profile.candidate_keys(empty).collect()] == [False, False]
    assert profile.key_columns(empty) == []


def test_keys(spark):
    df = spark.createDataFrame([(1, "a", None, 5, 1.0), (2, "b", "x", 5, 2.0), (3, "b", "y", 6, 3.0)],
                               "id int, name string, gap string, few int, real double")
    found = by_column(profile.candidate_keys(df))
    assert {c for c, r in found.items() if r["is_key"]} == {"id", "real"}
    assert found["gap"] == {"column": "gap", "n_rows": 3, "n_nonnull": 2, "n_distinct": 2, "is_key": False}
    assert profile.key_columns(df) == ["id", "real"]
    assert profile.key_columns(df, ["name"]) == []


def test_more_columns_than_one_batch(spark):
    df = spark.range(7).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(23)])
    found = by_column(profile.distinct_counts(df))
    assert [found[f"c{i}"]["n_distinct"] for i in range(23)] == [min(i + 1, 7) for i in range(23)]


def test_distinct_counts_of_every_type(spark):
    from datetime import date
    from decimal import Decimal

    rows = [
        (None, -5, 2**62, True, date(2024, 1, 1), datetime(2024, 1, 1), 0.0, "a", Decimal("1.10"), bytearray(b"\x00"), [1, None], (1, "x")),
        (1, 70_000, -(2**62), True, date(1900, 1, 1), datetime(2024, 1, 1, 0, 0, 1), -0.0, "", Decimal("1.1"), bytearray(b""), [1], (1, None)),
        (1, 70_000, 0, None, None, datetime(1900, 1, 1), float("nan"), "a", Decimal("2"), bytearray(b"\x00"), [], (1, None)),
        (1, 0, 0, False, date(1900, 1, 1), None, float("nan"), None, None, None, None, None),
        (1, None, 0, False, date(1900, 1, 1), None, 1e300, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "i int, l long, w long, f boolean, d date, t timestamp, x double, `a b` string, m decimal(9,2), y binary, r array<int>, s struct<p:int,q:string>"
    ).withColumn("n", F.col("t").cast("timestamp_ntz"))
    want = {"i": 1, "l": 3, "w": 3, "f": 2, "d": 2, "t": 3, "x": 3, "a b": 2, "m": 2, "y": 2, "r": 3, "s": 2, "n": 3}
    found = by_column(profile.distinct_counts(df))
    assert {c: r["n_distinct"] for c, r in found.items()} == want
    assert {r["n_rows"] for r in found.values()} == {5} and found["l"]["n_nonnull"] == 4
    assert by_column(profile.distinct_counts(df.select("i", "a b"), approximate=True))["a b"]["n_rows"] == 5


@pytest.mark.parametrize("bits", [0, 1, 64, 1 << 40])
def test_distinct_counts_do_not_depend_on_how_they_are_counted(spark, monkeypatch, bits):
    monkeypatch.setattr(profile, "BITS_PER_VALUE", bits)
    df = spark.range(30_000).select(
        ((F.col("id") * 7919) % 100_003 - 50_000).alias("spread"), (F.col("id") % 37).alias("few"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("gaps")
    )
    assert {c: r["n_distinct"] for c, r in by_column(profile.distinct_counts(df.repartition(5))).items()} == {"spread": 30_000, "few": 37, "gaps": 15_000}


def test_distinct_counts_do_not_copy_rows_by_expand(spark):
    found = profile.distinct_counts(spark.range(100).select("id", F.col("id").cast("string").alias("s"), (F.col("id") / 3).alias("d")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_construct_agg" in plan


def test_statistics_by_kind_of_column(spark):
    rows = [
        (1.0, "$3.50", ["x", "2"], '{"count": 4}', datetime(2024, 1, 1), True, "none"),
        (float("nan"), "", [], "bad", datetime(2024, 1, 2), False, "none"),
        (float("inf"), None, None, None, None, None, None),
        (3.0, "x7", ["1"], '{"value": "6"}', None, True, ""),
    ]
    df = spark.createDataFrame(
        rows, "n double, s string, a array<string>, j string, t timestamp_ntz, f boolean, w string"
    )
    found = by_column(profile.column_statistics(df, json_columns=["j"]))
    assert set(found) == {"n", "s", "a", "j", "t", "f"}
    assert found["n"] == {"column": "n", "n": 2, "min": 1.0, "max": 3.0, "mean": 2.0, "std": 1.0}
    assert (found["s"]["min"], found["s"]["max"]) == (3.5, 7.0)
    assert (found["a"]["min"], found["a"]["max"]) == (1.0, 2.0)
    assert (found["j"]["min"], found["j"]["max"]) == (4.0, 6.0)
    assert found["t"]["max"] - found["t"]["min"] == 86400 and found["t"]["mean"] is None


def test_sampled_statistics_take_that_many_values(spark):
    df = spark.range(5000).select((F.col("id") * 1.0).alias("v"), F.lit(None).cast("double").alias("none"))
    found = by_column(profile.column_statistics(df, sample_rows=1000))
    assert set(found) == {"v"} and found["v"]["n"] == 1000


def test_statistics_that_overflow_are_left_out(spark):
    df = spark.createDataFrame([(1.7e308,), (1.7e308,), (1.0,)], "v double")
    assert profile.column_statistics(df).count() == 0


def test_statistics_that_overflow_are_kept_where_asked(spark):
    # As DuckDB gives them; partitions without rows must not make a deviation NaN.
    df = spark.createDataFrame(
        [("8e299", 8e299, 1e160, 1.7e308), ("2", 8e299, 1.0000001e160, 1.7e308), ("x", 8e299, 0.9999999e160, 1.0)], "wide string, same double, near double, sum double"
    ).repartition(8)
    found = by_column(profile.column_statistics(df, keep_overflow=True))
    assert found["wide"] == {"column": "wide", "n": 2, "min": 2.0, "max": 8e299, "mean": 4e299, "std": math.inf}
    assert (found["same"]["mean"], found["same"]["std"]) == (pytest.approx(8e299), 0.0)
    assert found["near"]["std"] == pytest.approx(8.164965811398041e152, rel=1e-8)
    assert found["sum"]["mean"] == found["sum"]["std"] == math.inf
    assert set(by_column(profile.column_statistics(df))) == {"same", "near"}


def test_common_columns_keep_statistics_that_overflow(spark):
    tables = {"a": spark.createDataFrame([("8e299",), ("1",)], "v string"), "b": spark.createDataFrame([("1",)], "v string")}
    (row,) = catalog.common_columns_document(spark, tables, keep_overflow=True).collect()
    assert [(t["name"], t["statistics"]["max"], t["statistics"]["std"]) for t in row["tables"]] == [("a", 8e299, math.inf), ("b", 1.0, 0.0)]
    (row,) = catalog.common_columns_document(spark, tables).collect()
    assert [t["statistics"] is None for t in row["tables"]] == [True, False]


def test_id_ranges(spark):
    df = spark.createDataFrame([(1, "12x", math.nan, 5), (4, "zz", 2.0, 6), (None, None, None, 7)],
                               "GAME_ID long, text_id string, real_id double, other int")
    found = by_column(profile.id_ranges(df))
    assert {c: (r["min"], r["max"]) for c, r in found.items()} == {
        "GAME_ID": (1.0, 4.0), "text_id": (0.0, 12.0), "real_id": (2.0, 2.0),
    }


def test_wide_ids_stay_whole(spark):
    df = spark.createDataFrame([(2**53 + 1, "9007199254740993x"), (2**53 + 3, None)], "id long, text_id string")
    found = by_column(profile.id_ranges(df))
    assert {c: (r["min"], r["max"]) for c, r in found.items()} == {
        "id": (2**53 + 1, 2**53 + 3), "text_id": (2**53 + 1, 2**53 + 1)
    }


def test_profile_of_empty_tables_and_awkward_names(spark):
    df = spark.createDataFrame([], "`team.name` string, n string")
    rows = by_column(profile.text_profile(df))
    assert set(rows) == {"team.name", "n"} and rows["team.name"]["n_rows"] == 0 and rows["n"]["position"] == 1


def test_nan_is_no_value(spark):
    from courtside.operators.cleaning import drop_all_null_columns, drop_constant_columns

    df = spark.createDataFrame([(math.nan, 1.0, 1.0), (None, 1.0, 2.0), (math.nan, math.nan, 3.0)], "`a.b` double, same double, other double")
    assert drop_all_null_columns(df).columns == ["same", "other"]
    assert drop_constant_columns(df).columns == ["other"]


def test_few_values(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"))
    assert profile.few_values(df, "ten", 10) and not profile.few_values(df, "eleven", 10)


@pytest.fixture
def overlapping(spark):
    return {
        "one": spark.createDataFrame([(1, "5 kg", "z")], "id long, name string, only string"),
        "two": spark.createDataFrame([("b", 2), ("c", 4)], "name string, id int"),
        "three": spark.createDataFrame([(7.0,)], "id double"),
    }


def test_common_columns(spark, overlapping):
    metadata = catalog.describe_tables(spark, overlapping)
    report = catalog.common_columns_report(catalog.common_columns(metadata)).collect()
    assert [tuple(r) for r in report] == [("id", 3, "one, three, two", "0, 0, 1"), ("name", 2, "one, two", "1, 0")]


def test_common_columns_document_keeps_columns_with_numbers(spark, overlapping):
    document = catalog.common_columns_document(spark, overlapping)
    found = {r["column_name"]: {t["name"]: t["statistics"] for t in r["tables"]} for r in document.collect()}
    assert set(found) == {"id", "name"}
    assert found["name"]["two"] is None and found["name"]["one"]["max"] == 5.0
    assert (found["id"]["two"]["mean"], found["id"]["two"]["std"]) == (3.0, 1.0)


def test_column_pickers(spark, overlapping):
    df = overlapping["one"]
    assert catalog.columns_like(df, "ID", "na") == ["id", "name"]
    assert catalog.numeric_columns(df) == ["id"] and catalog.numeric_columns(df, exclude=["id"]) == []
    assert catalog.text_columns(df) == ["name", "only"]
    metadata = catalog.describe_tables(spark, overlapping)
    assert catalog.columns_containing(metadata, "ONL").first()["table_name"] == "one"
    by_table = {r["table_name"]: r["columns"] for r in catalog.columns_by_table(metadata).collect()}
    assert by_table == {"one": "id, name, only", "two": "name, id", "three": "id"}


def test_cleaning_drops(spark):
    df = spark.createDataFrame([(1, 2.0, None, 3), (1, None, None, 4)], "same int, gap double, none double, v int")
    assert cleaning.drop_all_null_columns(df).columns == ["same", "gap", "v"]
    assert cleaning.drop_constant_columns(df).columns == ["v"]
    assert cleaning.drop_null_rows(df.drop("none")).count() == 1
    assert cleaning.fill_null(df).first()["none"] == 0
    assert cleaning.coerce_numeric(df, ["v", "absent"]).dtypes[3] == ("v", "double")


def test_cleaning_for_a_load(spark):
    df = spark.createDataFrame([(float("nan"), "None", 1), (2.0, "ok", 2)], "x double, s string, n int")
    assert [tuple(r) for r in cleaning.clean_for_load(df).collect()] == [(None, None, 1), (2.0, "ok", 2)]
