"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E
from staywise.plans.testdata import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

duckdb = pytest.importorskip("duckdb")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=lambda r: tuple(map(str, r)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue_eur" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert got is not None
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())
