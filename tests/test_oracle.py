"""Every registered query against its SQL in DuckDB, on the smallest data."""

from functools import partial

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry_points
from skyledger.workload import catalog, oracle

QUERIES = {name: partial(catalog.run, name) for name in catalog.QUERIES}
SQL = oracle.all_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{DATA}/events.parquet'")
    return connection


def comparable(rows):
    return sorted(tuple("%.12g" % v if isinstance(v, float) else str(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    relation = duck.sql(SQL[name])
    assert columns == sorted(relation.columns)
    expected = duck.sql(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()
    assert comparable(df.select(columns).collect()) == comparable(expected)


def test_flagship(spark):
    assert entry_points.entry(spark).first().satellite_id == "SAT-11"
