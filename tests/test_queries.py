"""Each registered query against its SQL on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallyfold.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _norm(value):
    return f"{value:.9g}" if isinstance(value, float) else repr(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted_rows(df.columns, rows) == _sorted_rows(columns, result.fetchall())


@pytest.mark.parametrize("name", ["manifest_sorted", "history_list"])
def test_order(spark, db, name):
    rows = [tuple(r) for r in entry.queries()[name](spark, SF).collect()]
    assert [r[0] for r in rows] == [r[0] for r in db.execute(entry.oracle_sql()[name]).fetchall()]


def test_entry(spark):
    assert entry.entry(spark).count() == 1
