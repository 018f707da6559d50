"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, normal

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.columns and df.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
