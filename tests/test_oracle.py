"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest data set: row count, column names and the value multiset."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from adpulse.plans.registry import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = {name: q.build for name, q in load_all().items()}
ORACLES = {name: q.oracle for name, q in load_all().items() if q.oracle}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(s_rows) > 0
        return
    cur = duck.execute(ORACLES[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert "bid_win_price" in out.columns
