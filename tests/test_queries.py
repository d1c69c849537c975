"""Every query against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracle import all_sql
from checks.queries import all_queries
from tools.compare import TABLES, canonical

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    assert canonical(df.collect(), df.columns, order) == canonical(cursor.fetchall(), names, order)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["element_type", "cnt"] and df.count() > 0
