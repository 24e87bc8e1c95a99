"""Where queries and the SQL they are checked against are written down."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtside.session import tune
from courtside.views import Tables, view_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def checked(*views: str, sql: str) -> str:
    """``sql`` with the role views in front; ``sql`` may open with its own WITH."""
    if not views:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return view_ctes(*views) + ",\n" + body[5:]
    return view_ctes(*views) + "\n" + body


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL if there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
