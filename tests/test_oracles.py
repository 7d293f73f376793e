"""Every query against DuckDB on the same tables, whole results, values and duplicates."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    assert sorted(got.columns) == sorted(columns)
    order = sorted(range(len(columns)), key=columns.__getitem__)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got_rows = sorted((tuple(r) for r in got.select(sorted(got.columns)).collect()), key=key)
    want_rows = sorted((tuple(row[i] for i in order) for row in want), key=key)
    assert want_rows
    assert len(got_rows) == len(want_rows)
    assert got_rows == want_rows


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 150
