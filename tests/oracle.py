"""Run a registered query and its SQL over one folder and compare the results.

``python -m tests.oracle [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
import warnings

import duckdb

from courtside.registry import ORACLES, QUERIES
from courtside.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(table) -> list[str]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted("|".join(_plain(v) for v in row) for row in zip(*columns))


_TYPES = {"int": "int32", "large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}


def _types(table) -> dict[str, str]:
    out = {}
    for field in table.schema:
        name = str(field.type)
        out[field.name] = _TYPES.get(name, name)
    return dict(sorted(out.items()))


def compare(spark, con, name: str, folder: str) -> str:
    """'' when the results agree, else what differs."""
    ours = QUERIES[name](spark, folder).toArrow()
    if name not in ORACLES:
        return "" if ours.num_rows >= 0 else "no result"
    theirs = con.sql(ORACLES[name]).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(set(ours.column_names) ^ set(theirs.column_names))}"
    if _types(ours) != _types(theirs):
        a, b = _types(ours), _types(theirs)
        return "types " + str({k: (a[k], b[k]) for k in a if a[k] != b[k]})
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} != {theirs.num_rows}"
    left, right = _rows(ours), _rows(theirs)
    if left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(bad)} rows differ, first {bad[0]}"
    return ""


def main() -> None:
    warnings.filterwarnings("ignore")
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8, **{"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        check = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {check:4} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
