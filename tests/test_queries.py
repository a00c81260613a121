"""Every query against its SQL on the smallest tables; the flagship through the entry module."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as e
from tidemark.plans import catalog

DIR = "/root/testdata/sf0.001"
catalog.load()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    want = duck.execute(catalog.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())


def test_entry(spark):
    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
