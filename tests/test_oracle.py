"""Every registered query against its DuckDB oracle on the supplied tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from logtide.queries import REGISTRY
from logtide.sources.tables import TABLES

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(REGISTRY) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert len(srows) > 0
    assert _rows(df.columns, srows) == _rows(rel.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["log_level", "count"]
    rows = df.collect()
    assert [r.log_level for r in rows] == sorted(r.log_level for r in rows)
    assert sum(r["count"] for r in rows) > 0


def test_log_view_rows_equal_duckdb(spark, duck):
    from logtide import oracle
    from logtide.queries import logs

    s = sorted(tuple(r) for r in logs(spark, SF_SMALL).collect())
    d = sorted(duck.sql("with " + oracle.LOG_LINES + " select * from log_lines").fetchall())
    assert s == d
