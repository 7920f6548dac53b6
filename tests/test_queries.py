"""Every registered query against its SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from crawlspark.plans.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    result = contract.queries()[name](spark, str(SF_DIR))
    columns = sorted(result.columns)
    expected = sql.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({contract.oracle_sql()[name]})")
    types = [str(d[1]) for d in expected.description]
    assert [TYPES[result.schema[c].dataType.simpleString()] for c in columns] == types
    rows = [tuple(r) for r in result.select(*(f"`{c}`" for c in columns)).collect()]
    assert sorted(rows, key=str) == sorted(expected.fetchall(), key=str)
    assert rows or name.startswith("emails")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
