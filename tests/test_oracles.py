"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, abs_tol=2e-6)
    return a == b


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    order = sorted(df.columns)
    mine = [tuple(r[c] for c in order) for r in df.collect()]
    assert mine or name in ORACLE
    if name not in ORACLE:
        return
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == order
    theirs = [tuple(row[columns.index(c)] for c in order) for row in result.fetchall()]
    assert len(mine) == len(theirs)
    key = lambda row: tuple((x is None, str(x)) for x in row)
    for a, b in zip(sorted(mine, key=key), sorted(theirs, key=key), strict=True):
        assert all(close(x, y) for x, y in zip(a, b, strict=True)), (a, b)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
