"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_only_known_queries_lack_sql():
    """Those are tested against brute force; the rest must have SQL."""
    lack = {name for name in set(queries()) - set(oracle_sql()) if not name.startswith("op") and name != "pipeline"}
    assert not lack


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note
