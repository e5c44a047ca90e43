"""Runs a registered query and its SQL over the same folder and compares them."""

from __future__ import annotations

import datetime
import math

import duckdb

from leadpanel.sources.views import table_names

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in table_names():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def compare(spark, folder: str, fn, sql: str, con=None) -> str | None:
    """None when equal, else a short description of the difference."""
    df = fn(spark, folder)
    con = con or connect(folder)
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    got_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    rows = cur.fetchall()
    if got_types != want_types:
        return f"schema: {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    names = sorted(got_types)
    at = {n: i for i, n in enumerate([d[0] for d in cur.description])}
    want = sorted(tuple(_plain(r[at[n]]) for n in names) for r in rows)
    got = sorted(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if got == want:
        return None if got else "both empty"
    only_got = sorted(set(got) - set(want))[:3]
    only_want = sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} vs {len(want)} {names}\n   spark {only_got}\n   sql   {only_want}"
