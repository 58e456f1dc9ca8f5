"""Every registered query against its SQL text on DuckDB, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from tenderlens.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check.compare(spark, con, SF_DIR, name).startswith("ok")


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
