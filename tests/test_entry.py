"""The driver's contract, and every SQL against its query on the smallest data."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from paperloom.plans import registry


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) else v


def rows(t, names):
    return sorted(map(repr, zip(*[[plain(v) for v in t.column(c).to_pylist()] for c in names])))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "text" in df.columns


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and registry.FLAGSHIP in queries
    assert {"p4_found"} <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, duck, data, name):
    mine = registry.QUERIES[name](spark, data).toArrow()
    theirs = duck.sql(registry.SQL[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    names = sorted(mine.column_names)
    assert rows(mine, names) == rows(theirs, names)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, data, name):
    assert registry.QUERIES[name](spark, data).count() > 0
