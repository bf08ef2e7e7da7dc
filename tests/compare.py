"""Run registered queries beside their SQL counterparts and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, sf, query, sql):
    """(columns equal, spark rows, sql rows); both row lists sorted."""
    df = query(spark, sf)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    return sorted(df.columns) == sorted(names), _rows(df.columns, got), _rows(names, want)
