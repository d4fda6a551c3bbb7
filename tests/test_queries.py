"""Every query with SQL against DuckDB, every other one for running, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
Q, SQL = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = Q[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    res = duck.execute(SQL[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    want = sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in cols]) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(n for n in set(Q) - set(SQL) if Q[n].__module__.startswith("tessella.plans")))
def test_runs(spark, name):
    assert Q[name](spark, D).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
