"""Every query against the result DuckDB gives for its SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from scdflow.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
NAMES = [run.__name__ for run in catalog.QUERIES]
QUERIES = {name: entry.queries()[name] for name in NAMES}
STATEMENTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{FOLDER}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    expected = db.sql(STATEMENTS[name])
    result = QUERIES[name](spark, FOLDER)
    assert sorted(result.columns) == sorted(expected.columns)
    want = _sorted(expected.columns, expected.fetchall())
    got = _sorted(result.columns, result.collect())
    assert len(want) > 0
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
