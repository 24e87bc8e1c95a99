from __future__ import annotations

import csv
import os
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.constants import TABLE_GROUPS
from courtside.operators import catalog, unions
from courtside.operators.joins import star_joins
from courtside.session import materialize, scratch_path, shared_folder
from courtside.sources import copying
from courtside.sources import csv as csv_source
from courtside.sources.copying import load_csv_folder
from courtside.sources.csv import how_to_read, line_layout, scan_text
from courtside.sources.stores import CatalogStore, ConnectorStore, FolderStore
from courtside.streaming.incremental import incremental_csv_load, widened_schema, widened_table, widening_csv_load

GAME_CSV = """game_id,season_id,wl_home,fg3_pct_home,attendance,pts_home,game_date,overtime
1,22020,W,0.5,100.0,99,2020-01-01,True
2,22020,NaN,0.25,NA,101.5,2020-01-02,False
3,22021,L,,300.0,88,2020-01-03,true
"""


@pytest.fixture
def csv_folder(tmp_path):
    (tmp_path / "game.csv").write_text(GAME_CSV)
    (tmp_path / "player.csv").write_text('id,Draft_Year,note\n1,1990,"a, ""b"""\n2,None,x\n')
    (tmp_path / "team.v2.csv").write_text("id\n1\n")
    (tmp_path / "notes.txt").write_text("no table")
    return str(tmp_path)


@pytest.fixture
def database(spark, request):
    name = "d_" + request.node.name.replace("[", "_").replace("]", "").lower()[:40]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield CatalogStore(name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_files_and_groups(spark, csv_folder):
    assert list(csv_source.table_files(spark, csv_folder)) == ["game", "player", "team.v2"]
    assert list(csv_source.table_files(spark, csv_folder, first_dot=True)) == ["game", "player", "team"]
    assert list(csv_source.group_files(spark, csv_folder, "test_specific")) == ["game"]
    assert len({t for tables in TABLE_GROUPS.values() for t in tables}) == 16


def test_headers_go_on_after_a_bad_file(spark, csv_folder):
    files = {**csv_source.table_files(spark, csv_folder), "gone": os.path.join(csv_folder, "gone.csv")}
    metadata, unreadable = csv_source.headers(spark, files)
    assert set(unreadable) == {"gone"} and metadata.where("table_name = 'game'").count() == 8
    found = csv_source.files_with_column(spark, files, "DRAFT").collect()
    assert [(r["table_name"], r["columns"]) for r in found] == [("player", ["Draft_Year"])]


def test_load_types(spark, csv_folder):
    df = csv_source.load_csv(spark, f"{csv_folder}/game.csv", parse_dates=True)
    assert dict(df.dtypes) == {
        "game_id": "bigint", "season_id": "bigint", "wl_home": "string", "fg3_pct_home": "string",
        "attendance": "bigint", "pts_home": "double", "game_date": "timestamp_ntz", "overtime": "boolean",
    }
    rows = df.orderBy("game_id").collect()
    assert [r["attendance"] for r in rows] == [100, None, 300] and [r["wl_home"] for r in rows] == ["W", None, "L"]
    narrow = csv_source.load_csv(spark, f"{csv_folder}/game.csv", ladder="columnstore")
    assert dict(narrow.dtypes)["game_id"] == "tinyint" and dict(narrow.dtypes)["pts_home"] == "float"
    assert narrow.schema["wl_home"].metadata == {"max_len": 1}
    quoted = csv_source.load_csv(spark, f"{csv_folder}/player.csv").orderBy("id").collect()
    assert quoted[0]["note"] == 'a, "b"' and quoted[1]["Draft_Year"] is None


def test_load_folder_into_a_database(spark, csv_folder, database):
    outcome = copying.load_csv_folder(spark, csv_folder, database, group="game_specific")
    assert [tuple(r) for r in outcome.collect()] == [("game", "copied", 3, 3, None, "split")]
    again = copying.load_csv_folder(spark, csv_folder, database, group="game_specific", clear_first=True)
    assert again.first()["status"] == "copied" and database.read(spark, "game").count() == 3
    copying.load_csv_folder(spark, csv_folder, database, group="game_specific", mode="append")
    assert database.read(spark, "game").count() == 6
    assert catalog.list_tables(spark, [database.database]) == [(database.database, "game")]
    assert catalog.describe_database(spark, database.database).count() == 8


class Broken:
    """A store in which one table is empty and one cannot be read."""

    def tables(self, spark):
        return ["empty", "bad", "good"]

    def read(self, spark, table):
        if table == "bad":
            raise RuntimeError("cannot read")
        return spark.range(0 if table == "empty" else 5)


def test_copy_reports_every_table(spark, tmp_path):
    outcome = copying.copy_tables(spark, Broken(), FolderStore(str(tmp_path)))
    assert {r["table_name"]: (r["status"], r["rows_target"]) for r in outcome.collect()} == {
        "empty": ("skipped", None), "bad": ("failed", None), "good": ("copied", 5),
    }


def test_consolidate_rejects_unknown_origins_before_it_starts(spark, tmp_path):
    with pytest.raises(ValueError, match="tape"):
        copying.consolidate(spark, {"a": "tape"}, {}, FolderStore(str(tmp_path)))


def test_merge_is_the_same_when_run_again(spark, tmp_path, database):
    one, two = FolderStore(str(tmp_path / "one")), FolderStore(str(tmp_path / "two"), "json")
    one.write(spark.createDataFrame([(1, "a")], "id long, name string"), "people")
    two.write(spark.createDataFrame([(2, 5)], "id long, age long"), "people")
    two.write(spark.range(3), "other")
    for _ in range(2):
        outcome = copying.unite_databases(spark, {"one": one, "two": two}, database)
        assert {r["table_name"]: r["rows_target"] for r in outcome.collect()} == {"people": 2, "other": 3}
    assert set(database.read(spark, "people").columns) == {"id", "name", "age"}
    stacked, skipped = unions.stack_database(spark, database.database, limit=1)
    assert stacked.count() == 2 and skipped == {}


def test_append_like_creates_then_appends(spark, tmp_path, database):
    source = FolderStore(str(tmp_path))
    source.write(spark.range(4), "t")
    for n in (4, 8):
        copying.append_like(spark, source, database, "t")
        assert database.read(spark, "t").count() == n


def test_join_is_stored_and_exported_once(spark, tmp_path, database):
    tables = {
        "a": spark.createDataFrame([(1, 2)], "id long, x long"),
        "b": spark.createDataFrame([(1, 3)], "id long, y long"),
    }
    joins = star_joins({"id": ["a", "b"]}, tables)
    exported = FolderStore(str(tmp_path), "csv", {"header": "true"})
    name, stored = copying.export_join(spark, joins, database, exported)
    assert name == "joined_id" and [tuple(r) for r in stored.collect()] == [(1, 2, 3)]
    assert exported.read(spark, "joined_id").columns == ["id", "a__x", "b__y"]
    assert copying.export_join(spark, {}, database) is None


def test_shared_columns_go_through_json(spark, tmp_path):
    tables = {
        "a": spark.createDataFrame([(1, 2)], "id long, x long"),
        "b": spark.createDataFrame([(1, 3)], "id long, y long"),
    }
    catalog.common_columns_document(spark, tables).write.json(str(tmp_path / "common"))
    common = csv_source.read_json_config(spark, str(tmp_path / "common"))
    assert common["id"]["table_count"] == 2
    assert common["id"]["tables"][0]["statistics"] == {"min": 1.0, "max": 1.0, "mean": 1.0, "std": 0.0}
    assert star_joins(common, tables)["id"].columns == ["id", "a__x", "b__y"]
    (tmp_path / "groups.json").write_text('{"team": ["a",\n "b"]}')
    assert csv_source.read_json_config(spark, str(tmp_path / "groups.json")) == {"team": ["a", "b"]}


def test_ranges_cover_every_key_once(spark):
    df = spark.createDataFrame([(v,) for v in (5, 6, 7, 100, 101, 250, 251, 251, None)], "k long")
    bounds = copying.range_bounds(df, "k", 7)
    assert bounds[0][0] == 5 and bounds[-1][1] == 251
    assert all(b[0] == a[1] + 1 for a, b in zip(bounds, bounds[1:]))
    totals = copying.page_totals(df, "k", 7).collect()
    for r in totals:
        assert r["n_rows"] == df.where(F.col("k").between(r["low"], r["high"])).count()
    assert sum(r["n_rows"] for r in totals) == 8


@pytest.mark.parametrize("pages", [1, 3, 10, 50])
def test_pages_of_few_keys(spark, pages):
    df = spark.createDataFrame([(v,) for v in (-3, -1, 0, 4)], "k long")
    totals = copying.page_totals(df, "k", pages).collect()
    assert all(r["n_rows"] == df.where(F.col("k").between(r["low"], r["high"])).count() for r in totals)
    assert sum(r["n_rows"] for r in totals) == 4


def test_connector_options():
    store = ConnectorStore("jdbc", {"url": "jdbc:x"}, bounds={"game": ("game_id", 1, 900, 8)})
    assert store.read_options("game") == {
        "url": "jdbc:x", "dbtable": "game", "partitionColumn": "game_id", "lowerBound": "1", "upperBound": "900",
        "numPartitions": "8",
    }
    assert store.read_options("team") == {"url": "jdbc:x", "dbtable": "team"}
    assert store.external_table("g", "team") == "CREATE TABLE g USING jdbc OPTIONS (url 'jdbc:x', dbtable 'team')"
    with pytest.raises(ValueError):
        store.tables(None)


def test_stream_takes_every_file_once_over_restarts(spark, tmp_path):
    arriving, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    os.makedirs(arriving)
    schema = spark.createDataFrame([], "id long, name string, x double").schema

    def run():
        incremental_csv_load(spark, arriving, schema, target, progress, files_per_batch=1).awaitTermination()
        return sorted((tuple(r) for r in spark.read.parquet(target).collect()), key=str)

    for i in (1, 2):
        (tmp_path / "in" / f"{i}.csv").write_text(f"id,name,x\n{i},n{i},{i}.5\n")
    first = run()
    assert first == [(1, "n1", 1.5), (2, "n2", 2.5)]
    assert run() == first
    (tmp_path / "in" / "3.csv").write_text("id,name,x\n3.0,NA,bad\n")
    assert run() == [*first, (3, None, None)]


def test_stages_are_written_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    stored = materialize(spark.range(10), "ten")
    assert stored.count() == 10 and folder in stored.inputFiles()[0]


def test_csv_text_survives_the_sink_and_the_loader(spark, tmp_path):
    rows = [(1, 'a "b", c\nnext'), (2, "plain"), (3, 'back\\slash "q"')]
    df = spark.createDataFrame(rows, "id int, `team.name` string")
    store = FolderStore(str(tmp_path), "csv", {"header": "true"})
    store.write(df, "texts")
    assert sorted((int(r[0]), r[1]) for r in store.read(spark, "texts").collect()) == sorted(rows)
    loaded = FolderStore(str(tmp_path / "out"))
    outcome = copying.load_csv_folder(spark, str(tmp_path), loaded).first()
    assert outcome["status"] == "copied" and outcome["rows_target"] == 3
    assert sorted(tuple(r) for r in loaded.read(spark, "texts").collect()) == sorted(rows)


def test_databases_with_a_table_in_common_lose_none(spark, tmp_path):
    for name, n in (("one", 3), ("two", 5)):
        FolderStore(str(tmp_path / name)).write(spark.range(n), "t")
    target = FolderStore(str(tmp_path / "all"))
    kinds = {"files": lambda database: FolderStore(str(tmp_path / database))}
    outcome = copying.consolidate(spark, {"one": "files", "two": "files"}, kinds, target)
    assert sorted((r["rows_source"], r["rows_target"], r["status"]) for r in outcome.collect()) == [(3, 3, "copied"), (5, 5, "copied")]
    assert target.read(spark, "t").count() == 8


def test_ranges_cover_a_table_once(spark, tmp_path):
    source, target = FolderStore(str(tmp_path / "from")), FolderStore(str(tmp_path / "to"))
    source.write(spark.createDataFrame([(i * i, i) for i in range(50)] + [(None, -1)], "key long, v int"), "t")
    outcome = copying.copy_ranges(spark, source, target, "t", "key", 4).collect()
    assert sum(r["rows_target"] or 0 for r in outcome) == 51 and {r["status"] for r in outcome} <= {"copied", "skipped"}
    assert sorted(r["v"] for r in target.read(spark, "t").collect()) == [-1, *range(50)]


class _Breaks(FolderStore):
    """A folder of which one table cannot be read."""

    def read(self, spark, table):
        if table == "t":
            raise OSError("tape torn")
        return super().read(spark, table)


@pytest.mark.parametrize("place", ["folder", "catalog"])
def test_a_part_that_fails_leaves_the_old_table_whole(spark, tmp_path, database, place):
    for name, n in (("one", 3), ("two", 5)):
        FolderStore(str(tmp_path / name)).write(spark.range(n), "t")
        FolderStore(str(tmp_path / name)).write(spark.range(n), f"only_{name}")
    target = FolderStore(str(tmp_path / "all")) if place == "folder" else database
    target.write(spark.range(100, 107), "t")
    good = {"files": lambda d: FolderStore(str(tmp_path / d))}
    bad = {"files": lambda d: (_Breaks if d == "two" else FolderStore)(str(tmp_path / d))}
    origins = {"one": "files", "two": "files"}
    told = {(r["table_name"], r["database"]): r["status"] for r in copying.consolidate(spark, origins, bad, target).collect()}
    assert told == {("t", "one"): "withheld", ("t", "two"): "failed", ("only_one", "one"): "copied", ("only_two", "two"): "copied"}
    assert sorted(r["id"] for r in target.read(spark, "t").collect()) == list(range(100, 107))
    assert {"t", "only_one", "only_two"} <= set(target.tables(spark)) and not [t for t in target.tables(spark) if "staged" in t]
    again = copying.consolidate(spark, origins, good, target).collect()
    assert {r["status"] for r in again} == {"copied"}
    assert sorted(r["id"] for r in target.read(spark, "t").collect()) == sorted([*range(3), *range(5)])


def test_a_switch_that_was_cut_off_is_ended(spark, tmp_path, database):
    folder = FolderStore(str(tmp_path / "cut"))
    folder.write(spark.range(2), "t")
    folder.write(spark.range(9), folder.staged(spark, "t"))
    (tmp_path / "cut" / "_switches" / "t").mkdir(parents=True)  # the log entry, and nothing after it
    assert folder.end_switches(spark) == ["t"] and folder.read(spark, "t").count() == 9
    assert folder.end_switches(spark) == [] and folder.tables(spark) == ["t"]
    tables = database
    tables.write(spark.range(2), "cut")
    tables.write(spark.range(9), tables.staged(spark, "cut"))
    spark.sql(f"ALTER TABLE {database.database}.cut RENAME TO {database.database}.__retired_cut")
    assert tables.end_switches(spark) == ["cut"] and tables.read(spark, "cut").count() == 9


def test_ranges_of_a_crowded_key_have_like_numbers_of_rows(spark, tmp_path):
    crowded = "CASE WHEN id % 3 = 0 THEN 10000000000 + id % 700 WHEN id % 3 = 1 THEN -id ELSE id * 1000000 END AS key"
    df = spark.range(30_000).selectExpr(crowded, "id").unionByName(spark.createDataFrame([(None, -1)], "key long, id long"))
    for pages in (1, 7, 40):
        bounds = copying.balanced_bounds(df, "key", pages)
        assert len(bounds) == pages and all(b[0] == a[1] + 1 for a, b in zip(bounds, bounds[1:]))
        sizes = [df.where(F.col("key").between(*b)).count() for b in bounds]
        assert sum(sizes) == 30_000 and max(sizes) <= 2 * 30_000 / pages
    assert copying.balanced_bounds(df.where("key is null"), "key", 4) == []
    one_key = df.selectExpr("CAST(5 AS BIGINT) AS key")
    assert copying.balanced_bounds(one_key, "key", 4) == [(5, 5)]
    source, target = FolderStore(str(tmp_path / "from")), FolderStore(str(tmp_path / "to"))
    source.write(df, "t")
    for _ in range(2):  # a second copy repeats nothing
        told = copying.copy_ranges(spark, source, target, "t", "key", 7).collect()
        assert {r["status"] for r in told} == {"copied"} and sum(r["rows_target"] for r in told) == 30_001
        assert target.read(spark, "t").count() == 30_001


def test_a_cluster_needs_a_shared_folder_and_scratch_can_be_cleared(tmp_path):
    class Context:
        master = "local-cluster[2,1,1024]"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context, Conf()

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_settings_of_a_session_stay(spark):
    from courtside.session import tune

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert tune(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _written(folder, name, rows, **options):
    with open(folder / name, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=options.pop("lineterminator", "\n"), **options)
        writer.writerows([("a", "b"), *rows])
    return str(folder)


CELLS = st.text(alphabet='ab",\n\r \x01é', max_size=6)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(CELLS, CELLS), min_size=1, max_size=12), quoting=st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
def test_files_that_are_split_read_as_they_do_whole(spark, tmp_path_factory, rows, quoting):
    folder = _written(tmp_path_factory.mktemp("csv"), "x.csv", rows, quoting=quoting)
    split, whole = how_to_read(spark, folder)
    found, want = (sorted(map(str, scan_text(spark, folder, m).collect())) for m in (None, True))
    assert found == want
    broken = any("\n" in c or "\r" in c for row in rows for c in row)
    assert (split, whole) == (([], [folder]) if broken else ([folder], []))


def test_a_file_without_line_breaks_is_read_in_many_tasks(spark, tmp_path):
    rows = [(i, 'say "' + "x" * (i % 50) + '", twice') for i in range(60_000)]
    folder = _written(tmp_path, "x.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        text = scan_text(spark, folder)
        assert text.rdd.getNumPartitions() > 10 and text.count() == 60_000
        _written(tmp_path, "y.csv", [(1, "two\nlines")])
        both = scan_text(spark, folder)
        assert both.rdd.getNumPartitions() > 10 and both.count() == 60_001
        assert scan_text(spark, folder, True).rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    layout = {r["file"].rsplit("/", 1)[-1]: (r["n_lines"], r["n_open"]) for r in line_layout(spark, folder).collect()}
    assert layout == {"x.csv": (60_001, 0), "y.csv": (3, 2)}


def test_files_grow_in_number_not_in_size(spark):
    df = spark.range(1000).selectExpr("id", "repeat('é', 50) AS text", "CAST(NULL AS STRING) AS none")
    for times, files in ((1, 11), (4, 43)):
        dealt, number = csv_source.in_files(reduce(lambda a, b: a.union(b), [df] * times), at_least=6, file_bytes=10_000)
        sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert number == len(sizes) == files and max(sizes) < 130
    assert csv_source.in_files(df.limit(0), at_least=6)[1] == 6


def test_a_file_with_a_header_only_does_not_make_files_unlike(spark, tmp_path):
    folder = _written(tmp_path, "x.csv", [(1, "two\nlines")])
    _written(tmp_path, "empty.csv", [])
    assert how_to_read(spark, folder) == ([], [folder])
    assert scan_text(spark, folder).count() == 1
    _written(tmp_path, "y.csv", [(2, "one")])
    split, whole = how_to_read(spark, folder)
    assert [p.rsplit("/", 1)[-1] for p in (*split, *whole)] == ["y.csv", "x.csv"]
    assert scan_text(spark, folder).count() == 2


@pytest.mark.parametrize(
    ("line", "whole"),
    [
        ("a,b", True), ('"a,b",c', True), ('"a ""b""",c', True), ('"",x', True), ('x,""', True), ('"""",x', True), ('a,"b', False), ('b",c', False),
        ('"a""', False), ('5" nail,"open', False), ('a "b" c', False), ('"a" ,b', False), ('x"', False), ("", True), ('"""",""""', True), ('"\x01"', True),
    ],
)
def test_lines_that_hold_whole_cells(spark, tmp_path, line, whole):
    (tmp_path / "x.csv").write_text(f"h\n{line}\n")
    assert line_layout(spark, str(tmp_path)).first()["n_open"] == (0 if whole else 1)


def test_names_with_spaces_and_signs(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    _written(folder, "p 1.csv", [("1", "x\ny")])
    _written(folder, "p 2+%.csv", [("2", "z")])
    assert sorted(map(tuple, scan_text(spark, str(folder)).collect())) == [("1", "x\ny"), ("2", "z")]


def test_folder_tables_can_be_cleared(spark, tmp_path):
    store = FolderStore(str(tmp_path / "t"))
    _written(tmp_path, "x.csv", [("1", "2")])
    for _ in range(2):
        told = load_csv_folder(spark, str(tmp_path), store, clear_first=True).collect()
        assert [(r["table_name"], r["status"], r["rows_target"], r["files_read"]) for r in told] == [("x", "copied", 1, "split")]
    store.drop(spark, "x")
    store.drop(spark, "x")
    assert store.tables(spark) == []


def test_streamed_cells_may_hold_line_breaks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _written(folder, "x.csv", [("1", 'line one\n"line" two'), ("2", "x")])
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    incremental_csv_load(spark, str(folder), schema, str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, 'line one\n"line" two'), (2, "x")]


def test_headers_may_change_between_files(spark, tmp_path):
    arriving, target, progress = (str(tmp_path / n) for n in ("in put", "out", "progress"))
    os.makedirs(arriving)

    def run(name, text):
        (tmp_path / "in put" / name).write_text(text)
        widening_csv_load(spark, arriving, target, progress, files_per_batch=1).awaitTermination()
        return {f.name: f.dataType.simpleString() for f in widened_schema(spark, target).fields}

    assert run("1.csv", "id,x,none\n1,5,\n2,7,\n") == {"id": "bigint", "x": "bigint", "none": "string"}
    assert run("2.csv", "x,id\n0.5,3\n") == {"id": "bigint", "x": "double", "none": "string"}
    assert run("a b+3.csv", 'id,note,x\n4,"two\nlines",007\n') == {
        "id": "bigint", "x": "double", "none": "string", "note": "string"}
    assert run("4.csv", "id,x\n") == {"id": "bigint", "x": "double", "none": "string", "note": "string"}
    assert sorted(map(tuple, widened_table(spark, target).collect())) == [
        (1, 5.0, None, None), (2, 7.0, None, None), (3, 0.5, None, None), (4, 7.0, None, "two\nlines")]
    assert run("5.csv", "id,x\n5,seven\n")["x"] == "string"
    rows = widened_table(spark, target).select("id", "x").collect()
    assert sorted(map(tuple, rows)) == [(1, "5"), (2, "7"), (3, "0.5"), (4, "007"), (5, "seven")]


def test_a_batch_taken_again_repeats_nothing(spark, tmp_path):
    arriving, target = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(arriving)
    for i in range(4):
        (tmp_path / "in" / f"{i}.csv").write_text(f"id,c{i % 2}\n{i},{i}\n")
    for progress in ("first", "lost"):  # as if the log of the first run had been cut off
        widening_csv_load(spark, arriving, target, str(tmp_path / progress), files_per_batch=2).awaitTermination()
    assert sorted(r["id"] for r in widened_table(spark, target).collect()) == [0, 1, 2, 3]
