"""Every query of the core with a SQL twin gives the same rows as DuckDB on the small tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from wrackline.plans import capture_queries, skew_queries

QUERIES = {**skew_queries.QUERIES, **capture_queries.QUERIES}
SQL = {**skew_queries.SQL, **capture_queries.SQL}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    names = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    want = sorted(repr([plain(r[columns.index(c)]) for c in names]) for r in found.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 0
