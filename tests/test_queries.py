"""Every query against its SQL on the same tables."""

import os

import duckdb
import pytest

from celloom.expected import EXPECTED
from celloom.queries import QUERIES


@pytest.fixture(scope="module")
def db(data):
    connection = duckdb.connect()
    for name in os.listdir(data):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{name}'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, data, db, name):
    got = QUERIES[name](spark, data)
    want = db.execute(EXPECTED[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    want_rows = _rows(columns, want.fetchall())
    assert want_rows
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == want_rows
