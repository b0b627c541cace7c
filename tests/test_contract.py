"""Driver contract: every registered query matches its DuckDB oracle on sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from newslake.plans.tables import TABLES

from conftest import SF_SMALL

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not available")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_listed():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 35


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "day" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, scols) == _digest(drows, dcols)
