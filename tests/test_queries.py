"""Every named query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, DATA)
    columns = sorted(result.columns)
    got = [tuple(r[c] for c in columns) for r in result.collect()]
    answer = database.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert _sorted(got) == _sorted(tuple(r[i] for i in order) for r in answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    cells = contract.entry(spark)
    assert cells.columns == ["label", "prediction", "count"]
    assert sum(r["count"] for r in cells.collect()) == 6000
