"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as contract
from aerostat import catalog
from aerostat.testdata import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_registry_shape():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["city", "flight_count", "avg_temp"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    cur = duck.execute(contract.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert got == want


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_plan_has_no_cross_join_or_python(spark, name):
    df = contract.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
