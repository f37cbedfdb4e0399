"""Every registered query against its SQL check on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from stocktake.plans import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_a_check():
    assert set(all_queries.QUERIES) == set(all_queries.CHECKS)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())
    assert got == want
