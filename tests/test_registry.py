"""Every registered query against its DuckDB text on the smallest tables."""

import os

import duckdb
import pytest

import check
from plantmetrics.registry.load import ORACLE, QUERIES

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return con


def test_every_text_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, connection, name):
    agrees, detail = check.compare(spark, connection, name, ROOT)
    assert agrees, detail
