"""Run a registered query and its SQL, and describe the first differences."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(con, sql):
    result = con.execute(sql)
    found = [c[0] for c in result.description]
    names = sorted(found)
    at = [found.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)


def difference(df, con, sql) -> str | None:
    """None when columns and rows agree exactly."""
    names, mine = spark_rows(df)
    expected_names, theirs = sql_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(mine) != len(theirs):
        only = [r for r in mine if r not in theirs[:2000]][:2]
        return f"rows {len(mine)} != {len(theirs)}; e.g. {only}"
    for a, b in zip(mine, theirs):
        if a != b:
            cols = [n for n, x, y in zip(names, a, b) if x != y]
            return f"differ in {cols}:\n  spark {a}\n  sql   {b}"
        kinds = [n for n, x, y in zip(names, a, b) if type(x) is not type(y)]
        if kinds:
            return f"value types differ in {kinds}: {a} / {b}"
    return None
