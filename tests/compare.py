"""Comparing a Spark result with SQL on DuckDB, as multisets of rows."""

import collections
import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_value(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = multiset(names, found.fetchall())
    assert sorted(df.columns) == sorted(names)
    actual = multiset(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        raise AssertionError(f"extra {list(extra.items())[:5]}, missing {list(missing.items())[:5]}")
    return sum(actual.values())
