"""Every registered query against its SQL, on whole tables."""

import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem".split()
# The training-data operators have tests of their own.
SALES = [name for name in queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SALES) <= oracle_sql().keys()


@pytest.mark.parametrize("name", SALES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(names).collect()), key=repr)
    assert found == sorted(cursor.fetchall(), key=repr)


def test_entry(spark):
    assert entry(spark).count() == 2
