"""Loads, copies, paged totals and the incremental load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators import catalog, cleaning
from courtside.registry.core import query
from courtside.session import scratch_path
from courtside.sources import copying
from courtside.sources.csv import files_with_column, in_files, load_csv, table_files
from courtside.sources.stores import CatalogStore, FolderStore
from courtside.streaming.incremental import incremental_csv_load, widened_table, widening_csv_load

_CSV = {"header": "true"}


@query("csv_round_trip", "SELECT * FROM orders")
def csv_round_trip(t):
    """A table written as CSV text and loaded again with the types its content fits."""
    path = scratch_path(t.spark, "csv")
    t["orders"].write.option("header", True).csv(path)
    return load_csv(t.spark, path, parse_dates=True)


_COPIED = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part",
    "region", "supplier",
)


def _totals_sql(tables) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, 'copied' AS status, count(*) AS rows_source, count(*) AS rows_target,
  CAST(NULL AS VARCHAR) AS error FROM {t}"""
        for t in tables
    )


@query("copy_control_totals", _totals_sql(_COPIED))
def copy_control_totals(t):
    """All tables copied to another format, rows counted on both sides."""
    source = FolderStore(t.folder)
    target = FolderStore(scratch_path(t.spark, "copy"), "orc")
    return copying.copy_tables(t.spark, source, target, _COPIED)


@query(
    "consolidated_totals",
    f"""SELECT *, CASE WHEN table_name IN ('customer', 'orders') THEN 'sales' ELSE 'places' END AS database
FROM ({_totals_sql(("customer", "nation", "orders", "region"))})""",
)
def consolidated_totals(t):
    """Two databases in different formats brought together in one."""
    csv_home = scratch_path(t.spark, "places")
    for name in ("nation", "region"):
        t[name].write.option("header", True).csv(f"{csv_home}/{name}.csv")
    parquet_home = scratch_path(t.spark, "sales")
    for name in ("customer", "orders"):
        t[name].write.parquet(f"{parquet_home}/{name}.parquet")
    stores = {
        "files": lambda database: FolderStore(csv_home, "csv", _CSV),
        "columns": lambda database: FolderStore(parquet_home),
    }
    target = FolderStore(scratch_path(t.spark, "united"))
    return copying.consolidate(t.spark, {"places": "files", "sales": "columns"}, stores, target)


@query(
    "page_totals",
    """WITH s AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) - min(l_orderkey) + 1 AS reach FROM lineitem),
edges AS (SELECT CAST(i AS INTEGER) AS page, lo + reach * i // 20 AS low, lo + reach * (i + 1) // 20 - 1 AS high
  FROM s, range(20) AS r(i))
SELECT page, low, high, (SELECT count(*) FROM lineitem WHERE l_orderkey BETWEEN low AND high) AS n_rows FROM edges""",
)
def page_totals(t):
    return copying.page_totals(t["lineitem"], "l_orderkey", 20)


_TEXTS = """
SELECT 'documents' AS table_name, doc_id AS id, concat('He said "', text, '",', chr(10), ' twice ') AS text FROM {documents}
UNION ALL SELECT 'conversations', conv_id * 1000 + turn, concat(chr(10), '"', text, '"') FROM {conversations}"""


@query("csv_text_round_trip", _TEXTS.format(documents="documents", conversations="conversations"))
def csv_text_round_trip(t):
    """Texts with line breaks, commas and quotes through the CSV sink and the loader."""
    texts = t.spark.sql(_TEXTS, documents=t["documents"], conversations=t["conversations"])
    home = scratch_path(t.spark, "texts")
    FolderStore(home, "csv", _CSV).write(texts, "texts")
    loaded = FolderStore(scratch_path(t.spark, "loaded"))
    copying.load_csv_folder(t.spark, home, loaded)
    return loaded.read(t.spark, "texts")


@query(
    "csv_group_load",
    """SELECT 'team' AS table_name, n_nationkey AS id, n_name AS name FROM nation
UNION ALL SELECT 'team_details', r_regionkey, r_name FROM region""",
)
def csv_group_load(t):
    """The files of one group, loaded into cleared tables by the types they hold; files of other groups stay out."""
    home = scratch_path(t.spark, "group")
    files = FolderStore(home, "csv", _CSV)
    files.write(t["nation"].selectExpr("n_nationkey AS id", "n_name AS name"), "team")
    files.write(t["region"].selectExpr("r_regionkey AS id", "r_name AS name"), "team_details")
    files.write(t["supplier"].selectExpr("s_suppkey AS id", "s_name AS name"), "player")
    target = FolderStore(scratch_path(t.spark, "teams"))
    for _ in range(2):  # a second load leaves the same
        copying.load_csv_folder(t.spark, home, target, group="team_specific", clear_first=True, parse_dates=True)
    tables = target.tables(t.spark)
    return reduce(
        DataFrame.unionByName,
        [target.read(t.spark, n).select(F.lit(n).alias("table_name"), F.col("id").cast("int").alias("id"), "name") for n in tables],
    )


@query("copied_content", "SELECT * FROM events")
def copied_content(t):
    """A table as it is after a copy to another format."""
    target = FolderStore(scratch_path(t.spark, "copy"), "orc")
    copying.copy_tables(t.spark, FolderStore(t.folder), target, ["events"])
    return target.read(t.spark, "events")


@query(
    "consolidated_content",
    """SELECT l_orderkey AS id, CAST(l_quantity AS BIGINT) AS n FROM lineitem
UNION ALL SELECT o_orderkey, CAST(o_custkey AS BIGINT) FROM orders""",
)
def consolidated_content(t):
    """Two databases with a table of the same name: the rows of both."""
    homes = {"one": scratch_path(t.spark, "one"), "two": scratch_path(t.spark, "two")}
    FolderStore(homes["one"]).write(t["lineitem"].selectExpr("l_orderkey AS id", "CAST(l_quantity AS BIGINT) AS n"), "rows")
    FolderStore(homes["two"]).write(t["orders"].selectExpr("o_orderkey AS id", "CAST(o_custkey AS BIGINT) AS n"), "rows")
    target = FolderStore(scratch_path(t.spark, "both"))
    copying.consolidate(t.spark, {"one": "files", "two": "files"}, {"files": lambda d: FolderStore(homes[d])}, target)
    return target.read(t.spark, "rows")


@query("ranged_copy", "SELECT * FROM orders")
def ranged_copy(t):
    """A table as it is after a copy by ranges of its key."""
    target = FolderStore(scratch_path(t.spark, "ranges"))
    copying.copy_ranges(t.spark, FolderStore(t.folder), target, "orders", "o_orderkey", 4)
    return target.read(t.spark, "orders")


_BROKEN = """SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN concat(event_type, chr(10), '"', props, '",', chr(10)) ELSE props END AS text FROM {events}"""


@query(
    "csv_layout",
    """SELECT 'broken' AS table_name, 'copied' AS status, count(*) AS rows_target, 'whole' AS files_read FROM events
UNION ALL SELECT 'mixed', 'copied', count(*) * 2, 'split and whole' FROM events
UNION ALL SELECT 'quoted', 'copied', count(*), 'split' FROM events""",
)
def csv_layout(t):
    """How CSV files are read: in splits where no cell spans lines, quotes and commas or not, and as a whole where one does."""
    home = scratch_path(t.spark, "layouts")
    files = FolderStore(home, "csv", _CSV)
    broken = t.spark.sql(_BROKEN, events=t["events"])
    quoted = t["events"].selectExpr("event_id AS id", "concat(event_type, ', \"', props, '\"') AS text")
    files.write(broken, "broken")
    files.write(quoted, "quoted")
    for part in (broken, quoted):
        files.write(part, "mixed", "append")
    loaded = copying.load_csv_folder(t.spark, home, FolderStore(scratch_path(t.spark, "laid-out")))
    return loaded.select("table_name", "status", "rows_target", "files_read")


@query("csv_mixed_load", (_BROKEN + """ UNION ALL SELECT event_id, concat(event_type, ', "', props, '"') FROM {events}""").replace("{events}", "events"))
def csv_mixed_load(t):
    """The rows of a table of which some files are read in splits and others as a whole."""
    home = scratch_path(t.spark, "mixed")
    files = FolderStore(home, "csv", _CSV)
    files.write(t.spark.sql(_BROKEN, events=t["events"]), "mixed")
    files.write(t["events"].selectExpr("event_id AS id", "concat(event_type, ', \"', props, '\"') AS text"), "mixed", "append")
    return load_csv(t.spark, f"{home}/mixed.csv")


@query("incremental_texts", _TEXTS.format(documents="documents", conversations="conversations"))
def incremental_texts(t):
    """Texts with line breaks, commas and quotes taken in by a stream."""
    texts = t.spark.sql(_TEXTS, documents=t["documents"], conversations=t["conversations"])
    home, target, checkpoint = (scratch_path(t.spark, n) for n in ("arriving", "taken", "progress"))
    dealt, files = in_files(texts, at_least=6)
    FolderStore(home, "csv", _CSV).write(dealt, "texts")
    incremental_csv_load(t.spark, f"{home}/texts.csv", texts.schema, target, checkpoint, files_per_batch=files // 3).awaitTermination()
    return t.spark.read.schema(texts.schema).parquet(target)


@query("incremental_load", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def incremental_load(t):
    """A folder of CSV files taken in by a stream, a few files per batch."""
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    folder, target, checkpoint = (scratch_path(t.spark, n) for n in ("arriving", "taken", "progress"))
    dealt, files = in_files(orders, at_least=8)
    dealt.write.option("header", True).csv(folder)
    incremental_csv_load(t.spark, folder, orders.schema, target, checkpoint, files_per_batch=files // 2).awaitTermination()
    return t.spark.read.schema(orders.schema).parquet(target)


_SHAPES = (
    "SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS price FROM {orders} WHERE o_orderkey % 3 = 0",
    "SELECT o_orderstatus AS status, o_orderkey AS id, o_totalprice AS price FROM {orders} WHERE o_orderkey % 3 = 1",
    "SELECT o_orderpriority AS priority, concat('c', o_custkey) AS price, o_orderkey AS id FROM {orders} WHERE o_orderkey % 3 = 2",
)


@query("widening_load", """SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
  WHEN 1 THEN CAST(o_totalprice AS VARCHAR) ELSE concat('c', o_custkey) END AS price,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS priority
FROM orders""")
def widening_load(t):
    """CSV files with three headers, taken in by three runs of a stream: whole numbers, fractions, then texts under one name."""
    home, target, checkpoint = (scratch_path(t.spark, n) for n in ("arriving", "widened", "progress"))
    files = FolderStore(home, "csv", _CSV)
    for number, shape in enumerate(_SHAPES):
        files.write(t.spark.sql(shape, orders=t["orders"]).repartition(4), f"part{number}")
        widening_csv_load(t.spark, home, target, checkpoint, files_per_batch=3).awaitTermination()
    return widened_table(t.spark, target)


_HEADED = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


@query(
    "header_search",
    f"""SELECT table_name, string_agg(column_name, ', ' ORDER BY ordinal_position) AS columns
FROM information_schema.columns
WHERE table_name IN ({", ".join(f"'{t}'" for t in _HEADED)}) AND contains(lower(column_name), 'key') GROUP BY table_name""",
)
def header_search(t):
    """The CSV files with a column named like a key, by their headers."""
    home = scratch_path(t.spark, "headed")
    files = FolderStore(home, "csv", _CSV)
    for name in _HEADED:
        files.write(t[name], name)
    found = files_with_column(t.spark, table_files(t.spark, home), "KEY")
    return found.select("table_name", F.array_join("columns", ", ").alias("columns"))


_NUMBERS = "'TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE'"


@query(
    "databases_by_type",
    f"""SELECT CASE WHEN table_name IN ('customer', 'orders') THEN 'sales' ELSE 'places' END AS database, table_name,
  coalesce(string_agg(column_name, ', ' ORDER BY ordinal_position) FILTER (WHERE data_type IN ({_NUMBERS})), '') AS numeric_columns,
  coalesce(string_agg(column_name, ', ' ORDER BY ordinal_position) FILTER (WHERE data_type = 'VARCHAR'), '') AS text_columns
FROM information_schema.columns WHERE table_name IN ('customer', 'orders', 'nation', 'region') GROUP BY table_name""",
)
def databases_by_type(t):
    """The tables of two databases of the catalog, with their number and text columns."""
    rows = []
    for label, tables in (("sales", ("customer", "orders")), ("places", ("nation", "region"))):
        home = scratch_path(t.spark, label)
        database = f"{label}_{home[-32:]}"
        t.spark.sql(f"CREATE DATABASE {database} LOCATION '{home}'")
        store = CatalogStore(database)
        for name in tables:
            store.write(t[name], name)
        for _, name in catalog.list_tables(t.spark, [database]):
            df = store.read(t.spark, name)
            rows.append((label, name, ", ".join(catalog.numeric_columns(df)), ", ".join(catalog.text_columns(df))))
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.createDataFrame(rows, "database string, table_name string, numeric_columns string, text_columns string")


@query("bad_bytes_cleaned", "SELECT doc_id, replace(text, chr(65533), '') AS text, lang FROM documents")
def bad_bytes_cleaned(t):
    """Texts with bytes that are no characters, before, behind and between: only the characters stay."""
    bad = F.expr("CAST(concat(X'FF', encode(left(text, 20), 'UTF-8'), X'C3', encode(substr(text, 21), 'UTF-8'), X'E282') AS STRING)")
    return cleaning.clean_utf8(t["documents"].select("doc_id", bad.alias("text"), "lang"))


@query(
    "empty_tables_skipped",
    """SELECT 'nothing' AS table_name, 'skipped' AS status, 0 AS rows_source, CAST(NULL AS BIGINT) AS rows_target
UNION ALL SELECT 'orders', 'copied', count(*), count(*) FROM orders""",
)
def empty_tables_skipped(t):
    """A table without rows is told and not written."""
    source = FolderStore(scratch_path(t.spark, "some"))
    source.write(t["orders"], "orders")
    source.write(t["orders"].where("o_orderkey < 0"), "nothing")
    target = FolderStore(scratch_path(t.spark, "copied"))
    return copying.copy_tables(t.spark, source, target).drop("error")


@query("appended_like", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem")
def appended_like(t):
    """A table created like its source and filled, then appended to from another of that shape."""
    sales = FolderStore(scratch_path(t.spark, "sales")), FolderStore(scratch_path(t.spark, "items"))
    sales[0].write(t["orders"].select("o_orderkey", "o_totalprice"), "amounts")
    sales[1].write(t["lineitem"].selectExpr("l_orderkey AS o_orderkey", "l_extendedprice AS o_totalprice"), "amounts")
    target = FolderStore(scratch_path(t.spark, "amounts"))
    for store in sales:
        copying.append_like(t.spark, store, target, "amounts")
    return target.read(t.spark, "amounts")


class _Torn(FolderStore):
    """A folder whose tables cannot be read."""

    def read(self, spark, table):
        raise OSError("not there")


@query("consolidated_after_failure", "SELECT o_orderkey AS id FROM orders UNION ALL SELECT l_orderkey FROM lineitem")
def consolidated_after_failure(t):
    """Two databases brought together over an old table: a run that fails halfway changes nothing, the next one replaces it."""
    homes = {"one": scratch_path(t.spark, "one"), "two": scratch_path(t.spark, "two")}
    FolderStore(homes["one"]).write(t["orders"].selectExpr("o_orderkey AS id"), "rows")
    FolderStore(homes["two"]).write(t["lineitem"].selectExpr("l_orderkey AS id"), "rows")
    target = FolderStore(scratch_path(t.spark, "both"))
    old = t["customer"].selectExpr("c_custkey AS id")
    target.write(old, "rows")
    origins = {"one": "files", "two": "files"}
    copying.consolidate(t.spark, origins, {"files": lambda d: (_Torn if d == "two" else FolderStore)(homes[d])}, target)
    if target.read(t.spark, "rows").count() == old.count():
        copying.consolidate(t.spark, origins, {"files": lambda d: FolderStore(homes[d])}, target)
    return target.read(t.spark, "rows")
