"""Loads, copies and consolidation, with an outcome per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtside.operators.types import spark_schema
from courtside.operators.unions import stack_tables
from courtside.sources.csv import group_files, how_to_read, profiled_csv, table_files, typed

# Tables copied at the same time.
TABLES_AT_ONCE = 8

OUTCOME = "table_name string, status string, rows_source long, rows_target long, error string"


def _outcome(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per table."""
    return spark.createDataFrame(rows, OUTCOME)


Reader = Callable[[], tuple[DataFrame, int | None]]


def _copy_one(spark: SparkSession, read: Reader, target, table: str, mode: str, before: int | None = None) -> tuple:
    """Copy one table; whatever goes wrong is reported and does not stop the others.

    ``read`` gives the table, and its row count where reading it told. ``before``
    is how many rows the target has already, counted here if it is not known.
    """
    try:
        source, rows = read()
        if rows == 0 or (rows is None and source.isEmpty()):
            return (table, "skipped", 0, None, None)
        if before is None:
            before = target.read(spark, table).count() if mode == "append" and table in target.tables(spark) else 0
        seen = Observation()
        target.write(source.observe(seen, F.count(F.lit(1)).alias("n")), table, mode)
        rows = seen.get["n"]
        written = target.read(spark, table).count() - before
        return (table, "copied" if written == rows else "mismatch", rows, written, None)
    except Exception as error:  # noqa: BLE001 - reported per table
        return (table, "failed", None, None, str(error))


def _copy_all(spark: SparkSession, jobs: Sequence[tuple[Reader, object, str, str]]) -> list[tuple]:
    """Outcomes of (reader, target, table, mode) in order; some tables at a time, so that small ones fill the cluster."""
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda job: _copy_one(spark, *job)), jobs))


def copy_tables(
    spark: SparkSession,
    source,
    target,
    tables: Sequence[str] | None = None,
    mode: str = "overwrite",
    clean: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Copy tables from one store to another, each in one distributed job.

    Returns one row per table: copied (as many rows arrived as were read while
    writing), mismatch, skipped (no rows) or failed. ``clean`` is applied on the way.
    """
    names = source.tables(spark) if tables is None else tables

    def reader(table: str) -> Reader:
        def read():
            df = source.read(spark, table)
            return (clean(df) if clean else df), None

        return read

    return _outcome(spark, _copy_all(spark, [(reader(t), target, t, mode) for t in names]))


def consolidate(
    spark: SparkSession,
    origins: Mapping[str, str],
    stores: Mapping[str, Callable[[str], object]],
    target,
    mode: str = "overwrite",
    clean: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Copy several databases, each from the kind of store it lives in, into one.

    ``origins`` maps a database to a kind, ``stores`` a kind to a function from
    database to store. A kind that is not there is an error before anything
    runs. A table that several databases have gets the rows of all. When tables
    are overwritten in a catalog or a folder, the parts are staged and the table
    is replaced once, when all are there: if a part fails, the old table stays
    as it was and the other parts are told as ``withheld``. Stores behind a
    connector have no such switch; there the first part overwrites and the others
    append. A part without rows is skipped, and a table of which all are stays.
    """
    unknown = sorted({kind for kind in origins.values() if kind not in stores})
    if unknown:
        raise ValueError(f"no store of kind: {', '.join(unknown)}")
    parts: dict[str, list[tuple[str, object]]] = {}
    for database, kind in origins.items():
        store = stores[kind](database)
        for table in store.tables(spark):
            parts.setdefault(table, []).append((database, store))
    at_once = mode == "overwrite" and hasattr(target, "switch")
    if at_once:
        target.end_switches(spark)

    def reader(store, table: str) -> Reader:
        def read():
            df = store.read(spark, table)
            return (clean(df) if clean else df), None

        return read

    def one_table(table: str) -> list[tuple]:
        place = target.staged(spark, table) if at_once else table
        rows, there, arrived = [], False, 0
        for database, store in parts[table]:
            how = "append" if there else mode
            _, *told = _copy_one(spark, reader(store, table), target, place, how, arrived if at_once else None)
            if told[0] in ("copied", "mismatch"):
                # Only a table that is there now may be appended to.
                there, arrived = True, arrived + told[2]
            rows.append((table, *told, database))
        if at_once and there and all(r[1] in ("copied", "skipped") for r in rows):
            target.switch(spark, table)
        elif at_once:
            target.drop(spark, place)
            rows = [(table, "withheld", *r[2:4], "another part failed", r[5]) if r[1] == "copied" else r for r in rows]
        return rows

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one_table), parts))
    return spark.createDataFrame([r for rows in done for r in rows], OUTCOME + ", database string")


def unite_databases(spark: SparkSession, sources: Mapping[str, object], target) -> DataFrame:
    """All tables of several databases in one; tables of the same name are appended to each other.

    The target is replaced, so a second run does not repeat rows.
    """
    by_table: dict[str, dict[str, object]] = {}
    for database, store in sources.items():
        for table in store.tables(spark):
            by_table.setdefault(table, {})[database] = store

    def reader(table: str) -> Reader:
        def read():
            parts = {database: store.read(spark, table) for database, store in by_table[table].items()}
            return stack_tables(parts, source_column=None), None

        return read

    return _outcome(spark, _copy_all(spark, [(reader(t), target, t, "overwrite") for t in sorted(by_table)]))


def append_like(spark: SparkSession, source, target, table: str) -> None:
    """Create the table like its source if it is missing, then append all rows."""
    target.write(source.read(spark, table), table, mode="append")


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    target,
    group: str | None = None,
    ladder: str = "warehouse",
    mode: str = "overwrite",
    clear_first: bool = False,
    first_dot: bool = False,
    multiline: bool | None = None,
    **options,
) -> DataFrame:
    """Load the CSV files of a folder, or of one group, as typed tables.

    ``clear_first`` drops the tables that are about to be loaded. Files in which
    a cell holds a line break are read as a whole, others in splits, and
    ``files_read`` tells which; ``multiline`` declares it for all files.
    """
    files = group_files(spark, folder, group) if group else table_files(spark, folder, first_dot)
    if clear_first:
        for table in files:
            target.drop(spark, table)

    ways: dict[str, str] = {}

    def reader(table: str, path: str) -> Reader:
        def read():
            split, whole = how_to_read(spark, path, multiline)
            ways[table] = "split" if not whole else "whole" if not split else "split and whole"
            text, profiles = profiled_csv(spark, path, split, whole)
            rows = profiles[0]["n_rows"] if profiles else 0
            return typed(text, spark_schema(profiles, ladder, **options)), rows

        return read

    outcomes = _copy_all(spark, [(reader(t, path), target, t, mode) for t, path in files.items()])
    return spark.createDataFrame([(*row, ways.get(row[0])) for row in outcomes], OUTCOME + ", files_read string")


def export_join(spark: SparkSession, joins: Mapping[str, DataFrame], target, csv_target=None) -> tuple[str, DataFrame] | None:
    """Store the first of the joins as ``joined_<column>``, and as CSV from what was stored.

    The join runs once. None when there is nothing to join.
    """
    for column, joined in joins.items():
        table = f"joined_{column}"
        target.write(joined, table, mode="ignore")
        stored = target.read(spark, table)
        if csv_target is not None:
            csv_target.write(stored, table, mode="overwrite")
        return table, stored
    return None


# --- reading in ranges ---


def range_bounds(df: DataFrame, key: str, pages: int) -> list[tuple[int, int]]:
    """Ends of up to ``pages`` equal key ranges, both inclusive, that cover every key once."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    reach = high - low + 1
    pages = min(pages, reach)
    edges = [low + reach * i // pages for i in range(pages + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:])]


# Cells a crowded range is cut into per pass, and cells to a page at the least.
_CUTS, _CELLS = 16, 8


def _number_of(key: str, starts: Sequence[int]):
    """Which range a key is in: how many of the sorted starts lie at or below it, less one. Found by halving."""
    if len(starts) == 1:
        return F.lit(0)
    half = len(starts) // 2
    return F.when(F.col(key) < F.lit(starts[half]), _number_of(key, starts[:half])).otherwise(
        _number_of(key, starts[half:]) + half
    )


def balanced_bounds(df: DataFrame, key: str, pages: int) -> list[tuple[int, int]]:
    """Ends of up to ``pages`` ranges of a whole-number key with like numbers of rows, both inclusive.

    Every key from the smallest to the largest is in one range. Cells with too
    many rows are cut and counted again until each has an eighth of a page or is
    one key, so no range has more than 9/8 of the mean but for one with a key
    that has as many rows by itself. The driver holds at most some hundred
    cells a page, whatever the table.
    """
    key_column = F.col(key).cast("bigint")
    keys = df.select(key_column.alias(key)).where(F.col(key).isNotNull())
    low, high, n = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if low is None:
        return []
    most = max(1, n // (pages * _CELLS))
    cells, crowded = [], [(low, high, n)]
    while crowded:
        starts = [a for a, _, _ in crowded]
        number = _number_of(key, starts)
        width = F.get(F.array(*[F.lit((b - a) // _CUTS + 1).cast("bigint") for a, b, _ in crowded]), F.col("cell"))
        start = F.get(F.array(*[F.lit(a).cast("bigint") for a in starts]), F.col("cell"))
        end = F.get(F.array(*[F.lit(b).cast("bigint") for _, b, _ in crowded]), F.col("cell"))
        counted = (
            keys.withColumn("cell", F.when(F.col(key) >= F.lit(starts[0]), number))
            .withColumns({"start": start, "width": width})
            .where(F.col(key) <= end)
            # As decimals, since the reach of all 64-bit keys is no 64-bit number.
            .withColumn("cut", F.floor((F.col(key).cast("decimal(20,0)") - F.col("start")) / F.col("width")))
            .groupBy("cell", "cut")
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        )
        found = [(r["low"], r["high"], r["n"]) for r in counted.collect()]
        cells += [c for c in found if c[2] <= most or c[0] == c[1]]
        crowded = sorted(c for c in found if c[2] > most and c[0] < c[1])
    # Pages end where a cell reaches the next share of the rows.
    edges, seen, page = [], 0, 1
    for _, end, rows in sorted(cells):
        seen += rows
        if seen >= n * page / pages:
            edges.append(end)
            page = seen * pages // n + 1
    edges[-1] = high
    return list(zip([low, *[b + 1 for b in edges[:-1]]], edges))


def copy_ranges(spark: SparkSession, source, target, table: str, key: str, pages: int) -> DataFrame:
    """Copy a table by ranges of a whole-number key: one row per range with what was read and what arrived.

    page, low, high, status, rows_source, rows_target, error. The ranges have
    like numbers of rows. One job writes them all and counts each on the way; the
    target is read once to count what arrived. In a catalog or a folder the rows
    are staged and replace the old table only if every range is whole, so a copy
    that fails leaves what was there and can be run again. Rows without a key go
    with the first range; a range is skipped if it has no rows, and a table without keys copies nothing.
    """
    schema = "page int, low long, high long, status string, rows_source long, rows_target long, error string"
    df = source.read(spark, table)
    bounds = balanced_bounds(df, key, pages)
    if not bounds:
        return spark.createDataFrame([], schema)
    at_once = hasattr(target, "switch")
    if at_once:
        target.end_switches(spark)
    place = target.staged(spark, table) if at_once else table
    number = F.coalesce(_number_of(key, [low for low, _ in bounds]), F.lit(0))
    counts = [F.count_if(number == i).alias(f"n_{i}") for i in range(len(bounds))]
    try:
        seen = Observation()
        target.write(df.observe(seen, *counts), place, "overwrite")
        read = [seen.get[f"n_{i}"] for i in range(len(bounds))]
        arrived = dict(target.read(spark, place).groupBy(number.alias("page")).count().collect())
        written = [arrived.get(i, 0) for i in range(len(bounds))]
        whole = read == written
        if at_once and whole:
            target.switch(spark, table)
        elif at_once:
            target.drop(spark, place)
    except Exception as error:  # noqa: BLE001 - reported per range
        if at_once:
            target.drop(spark, place)
        return spark.createDataFrame([(i, a, b, "failed", None, None, str(error)) for i, (a, b) in enumerate(bounds)], schema)
    status = [("withheld" if at_once and not whole else "copied") if r == w else "mismatch" for r, w in zip(read, written)]
    return spark.createDataFrame([(i, *bounds[i], status[i], read[i], written[i], None) for i in range(len(bounds))], schema)


def page_totals(df: DataFrame, key: str, pages: int) -> DataFrame:
    """(page, low, high, n_rows) per key range, to check a ranged copy against.

    Ranges of a key are the same on every read, unlike pages by row number.
    """
    spark = df.sparkSession
    bounds = range_bounds(df, key, pages)
    if not bounds:
        return spark.createDataFrame([], "page int, low long, high long, n_rows long")
    low, reach = bounds[0][0], bounds[-1][1] - bounds[0][0] + 1
    # How many range starts lie at or below the key.
    number = F.expr(f"CAST(((CAST(`{key}` AS BIGINT) - {low} + 1) * {len(bounds)} - 1) DIV {reach} AS INT)")
    counts = (
        df.where(F.col(key).isNotNull())
        .select(number.alias("page"))
        .groupBy("page")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    edges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(bounds)], "page int, low long, high long")
    return edges.join(counts, "page", "left").na.fill(0, ["n_rows"]).select("page", "low", "high", "n_rows")
