"""Runs a query on Spark and its SQL on DuckDB over the same tables."""

import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(df, con, sql):
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, found.fetchall())
