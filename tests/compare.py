"""Runs a registered query and its SQL counterpart and compares the row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0 if v != 0 else 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v if v is None or isinstance(v, (bool, str)) else repr(v)


def multiset(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, sql: str, con) -> tuple[bool, str]:
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expect = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    a, b = multiset(df.columns, rows), multiset(names, expect)
    if a == b:
        return True, f"{len(rows)} rows"
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return False, f"{len(rows)} vs {len(expect)} rows\n   cols  {sorted(names)}\n   spark {only_a}\n   sql   {only_b}"
