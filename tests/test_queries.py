"""Every query against its SQL in an independent engine, on the given tables."""

import os
import sys

import duckdb
import pytest

from conftest import SF_DIR

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402

QUERIES, ORACLES = driver.catalog.all_queries(), driver.oracles.all_sql()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        if file.endswith(".parquet"):
            connection.execute(f"create view {file[:-8]} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())

    cursor = oracle.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    names = list(described)
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())

    assert sorted(described) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields} == described
    assert got == expected
    assert got


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
