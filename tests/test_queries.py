"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from docloom.plans import all_oracles, all_queries
from tests.check import rows_of

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    # SQL over the tables cannot see the files they lie in: test_streaming.py has that query's test.
    assert set(all_queries()) - {"object_files"} == set(all_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(all_oracles()))
def test_query(spark, duck, name):
    df = all_queries()[name](spark, SF)
    cursor = duck.execute(all_oracles()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
