"""Every registered query with a SQL twin gives the twin's rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from tests.conftest import SF

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_twin_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert {"conv_id", "turn", "reward", "advantage"} <= set(df.columns)
    assert df.count() > 0
