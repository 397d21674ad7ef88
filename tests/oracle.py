"""Comparison of a query with its SQL twin in DuckDB, by column names and values, without order."""

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{data}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v.asDict().values())
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr), [names[i].lower() for i in order]


def compare(con, df, sql):
    got, names = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want, other = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == other
    assert len(got) == len(want), (len(got), len(want))
    for a, b in zip(got, want):
        assert a == b, (a, b)
