"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    rows = got.collect()
    assert len(got.columns) == len(set(got.columns))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    expected = result.fetchall()
    assert _rows(got.columns, rows) == _rows(columns, expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
