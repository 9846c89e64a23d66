"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from lakeloom.workloads import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = df.collect()
    r = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, r.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
