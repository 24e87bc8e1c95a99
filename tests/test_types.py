from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from courtside.operators import cleaning, types

LOADED = st.sampled_from(["boolean", "Int64", "Float64", "datetime64[ns]", "string"])
ROWSTORE = st.one_of(
    st.sampled_from(["SMALLINT", "INTEGER", "BIGINT", "REAL", "DOUBLE PRECISION", "BOOLEAN", "TIMESTAMP", "TEXT"]),
    st.integers(1, 255).map(lambda n: f"VARCHAR({n})"),
)


@given(LOADED, LOADED, LOADED)
def test_loaded_types_form_a_lattice(a, b, c):
    merge = types.merge_loaded
    assert merge(a, a) == a
    assert merge(a, b) == merge(b, a)
    assert merge(merge(a, b), c) == merge(a, merge(b, c))


@given(ROWSTORE, ROWSTORE, ROWSTORE)
def test_rowstore_types_form_a_lattice(a, b, c):
    merge = types.merge_rowstore
    assert merge(a, a) == a
    assert merge(a, b) == merge(b, a)
    assert merge(merge(a, b), c) == merge(a, merge(b, c))


def test_merges_that_lose_nothing():
    assert types.merge_rowstore("TEXT", "VARCHAR(3)") == "TEXT"
    assert types.merge_rowstore("BIGINT", "REAL") == "DOUBLE PRECISION"
    assert types.merge_rowstore("VARCHAR(3)", "VARCHAR(12)") == "VARCHAR(12)"
    assert types.render_rowstore("VARCHAR(3)") == "VARCHAR(10)"
    assert types.merge_schemas([{"a": "SMALLINT"}, {"a": "BIGINT", "b": "TEXT"}]) == {"a": "BIGINT", "b": "TEXT"}
    assert types.merge_loaded("boolean", "Float64") == "Float64"


CELLS = {
    "tiny": ["1", "-128", "127"],
    "small": ["1", "300", None],
    "wide": ["1", "9223372036854775807", "2"],
    "whole_float": ["1.0", "3.0", "NA"],
    "real": ["1.5", "2", "3"],
    "huge": ["1e39", "2", "3"],
    "flag": ["True", "false", "TRUE"],
    "when": ["2024-01-01 10:00:00", "2024-01-02", "2024-05-06"],
    "word": ["a", "bcd", ""],
    "long_word": ["x" * 256, "y", "z"],
    "nothing": [None, "", "NaN"],
    "wl_home": ["1", "2", "3"],
}
EXPECTED = {
    "tiny": ("Int8", "SMALLINT", "INT64"),
    "small": ("Int16", "SMALLINT", "INT64"),
    "wide": ("Int64", "BIGINT", "INT64"),
    "whole_float": ("Int8", "SMALLINT", "INT64"),
    "real": ("Float32", "REAL", "FLOAT64"),
    "huge": ("Float64", "DOUBLE PRECISION", "FLOAT64"),
    "flag": ("UInt8", "BOOLEAN", "BOOL"),
    "when": ("FixedString(19)", "VARCHAR(19)", "STRING"),
    "word": ("FixedString(3)", "VARCHAR(3)", "STRING"),
    "long_word": ("String", "TEXT", "STRING"),
    "nothing": ("Int64", "INTEGER", "INT64"),
    "wl_home": ("FixedString(1)", "VARCHAR(1)", "STRING"),
}


def frame(spark):
    schema = ", ".join(f"{c} string" for c in CELLS)
    return spark.createDataFrame(list(zip(*CELLS.values())), schema)


def test_ladders(spark):
    df = frame(spark)
    for i, ladder in enumerate(("columnstore", "rowstore", "warehouse")):
        found = {r["column"]: r["inferred_type"] for r in types.infer_types(df, ladder).collect()}
        assert found == {c: names[i] for c, names in EXPECTED.items()}
    rows = {r["column"]: r["nullable"] for r in types.infer_types(df, "rowstore").collect()}
    assert {c for c, nullable in rows.items() if nullable} == {"small", "whole_float", "word", "nothing"}


def test_dates_are_recognised_on_request(spark):
    found = {r["column"]: r["inferred_type"] for r in types.infer_types(frame(spark), "rowstore", parse_dates=True).collect()}
    assert found["when"] == "TIMESTAMP"


def test_integral_columns_become_whole(spark):
    found = dict(cleaning.demote_integral(frame(spark).select("whole_float", "word", "real", "wl_home", "small")).dtypes)
    assert found == {"whole_float": "string", "word": "string", "real": "string", "wl_home": "string", "small": "bigint"}
    numbers = spark.createDataFrame([(1.0, 1.5, None), (float("nan"), 2.0, None)], "a double, b double, c double")
    demoted = cleaning.demote_integral(numbers)
    assert dict(demoted.dtypes) == {"a": "bigint", "b": "double", "c": "double"}
    assert [r["a"] for r in demoted.collect()] == [1, None]


def test_source_types_map_by_name():
    assert types.map_source_type("character varying", "rowstore") == "String"
    assert types.map_source_type("timestamp without time zone", "rowstore") == "DateTime"
    assert types.map_source_type("VARCHAR(20)", "rowstore") == "String"
    assert types.map_source_type("bigint", "rowstore") == "Int64"
    assert types.map_source_type("FLOAT64", "warehouse") == "Float64"
    assert types.map_source_type("geography", "warehouse") == "String"


def test_ddl():
    columns = [("a", "Int8", True), ("b", "String", False)]
    assert types.render_ddl(columns, "columnstore") == "`a` Nullable(Int8), `b` String"
    assert types.render_ddl([("a", "VARCHAR(3)", True)], "rowstore") == '"a" VARCHAR(10)'


def test_consolidated_schema_and_named_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "later", 1, 1.5, True)], "game_date string, at_time string, n int, x float, flag boolean"
    )
    dates = types.dates_by_name(df)
    assert dates == ["game_date"]
    schema = types.consolidated_schema(df, dates)
    assert schema.simpleString() == "struct<game_date:timestamp_ntz,at_time:string,n:bigint,x:double,flag:string>"
    assert types.cast_to(df, schema).first()["n"] == 1
