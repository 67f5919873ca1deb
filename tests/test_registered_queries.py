"""Every registered query against its SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom.plans.checked import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.fixture(scope="module")
def check():
    connection = duckdb.connect()
    connection.execute("set TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def shown(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, check, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = check.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(str(tuple(map(shown, row))) for row in cursor.fetchall())
    assert sorted(str(tuple(shown(r[n]) for n in names)) for r in df.collect()) == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 100
