"""Compare a catalog query with its check SQL on the shared tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, Decimal):
        return f"d{value}"
    if isinstance(value, float):
        return f"f{value + 0.0!r}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, dt.datetime):
        return f"t{value.isoformat()}"
    if isinstance(value, dt.date):
        return f"D{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return f"s{value}"


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows_of(names, cur.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns: spark={sorted(df.columns)} sql={sorted(names)}"
    if len(actual) != len(expected):
        return f"rows: spark={len(actual)} sql={len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ; first: spark={str(bad[0][0])[:700]} sql={str(bad[0][1])[:700]} cols={sorted(names)}"
    return None
