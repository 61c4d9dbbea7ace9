"""Side-by-side runs of queries and their SQL."""

import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in os.listdir(sf_dir):
        if t.endswith(".parquet"):
            p = os.path.join(sf_dir, t)
            p = f"{p}/*.parquet" if os.path.isdir(p) else p
            c.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(repr([plain(r[c]) for c in cols]) for r in df.collect())
    cur = connect(sf_dir).execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    want = Counter(repr([plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
