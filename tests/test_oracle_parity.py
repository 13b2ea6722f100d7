"""Every registered query equals its DuckDB oracle SQL (sf0.001).

Exact comparison: decimals compare exactly, doubles bit for bit, row
multisets order-insensitively, column names as sets.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from lettermon.oracle import oracle_sql
from lettermon.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return con


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def test_registries_match():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    rel = duck.sql(E.oracle_sql()[name])
    idx = {c: i for i, c in enumerate(rel.columns)}
    assert sorted(rel.columns) == cols
    want = sorted((tuple(r[idx[c]] for c in cols) for r in rel.fetchall()), key=_key)
    assert len(got) == len(want)
    assert got == want
