"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def by_name(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["media_id", "event_date", "total_loads", "total_plays"] and got.count()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, database, name):
    got = entry.queries()[name](spark, SF)
    data = [tuple(r) for r in got.collect()]
    assert data
    if name in entry.oracle_sql():
        cursor = database.execute(entry.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert by_name(data, got.columns) == by_name(cursor.fetchall(), columns)
