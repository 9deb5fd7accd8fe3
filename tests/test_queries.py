"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, open_tables
from querybook.registry import ORACLES, QUERIES
from tests.conftest import DATA


@pytest.fixture(scope="module")
def connection():
    return open_tables(DATA)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, connection, name):
    good, text = compare(spark, connection, DATA, name, oracle_sql()[name])
    assert good, text
    assert text.endswith("rows  "), f"column types differ: {text}"


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[0] == "summary_key" and frame.count() > 0


def test_every_warehouse_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())
