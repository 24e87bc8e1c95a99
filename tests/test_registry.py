"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from courtside.registry import ORACLES, QUERIES
from tests.conftest import FOLDER
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    assert compare(spark, duck, name, FOLDER) == ""


def test_every_check_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
