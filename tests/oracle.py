"""Compare a registered query with its SQL on the same files."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return repr(float(v) + 0.0)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when rows and column names agree, otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))} differ"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} rows differ, columns {sorted(names)}, first: {wrong[0][0]} expected {wrong[0][1]}"
    return None
