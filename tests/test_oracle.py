"""Every registered query against its DuckDB oracle SQL: row count, columns and values."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from visitlens.plans.oracle import oracle_sql
from visitlens.plans.queries import QUERIES
from visitlens.sources.tables import TABLE_NAMES

DATA = os.environ.get("VISITLENS_ORACLE_DIR", "/root/testdata/sf0.001")


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(rows, df.columns) == digest(res.fetchall(), ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1 and "session_count" in df.columns
