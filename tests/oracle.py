"""Runs a query and its SQL twin on the same tables and compares rows without order."""

import math
import os
from collections import Counter

import duckdb

DATA = "/root/testdata/sf0.001"


def connect():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, con, query, sql):
    df = query(spark, DATA)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = con.execute(sql)
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in at) for r in res.fetchall())
    assert got == want
