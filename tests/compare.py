"""Runs registered plans next to their SQL check and compares every value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else ("nan" if math.isnan(value) else value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple((type(v := plain(row[i])).__name__, v) for i in order) for row in rows),
        key=repr,
    )


def differences(spark, con, plan, sql: str, folder: str) -> list[str]:
    """Empty when the plan and its check agree in columns, types and every value."""
    df = plan(spark, folder)
    got_columns = df.columns
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    got = rows_of(got_columns, [tuple(r) for r in df.collect()])
    if sorted(got_columns) != sorted(want_columns):
        return [f"columns {sorted(got_columns)} want {sorted(want_columns)}"]
    if not want:
        return ["the check has no rows"]
    if len(got) != len(want):
        extra = [g for g in got if g not in set(want)][:2]
        lacking = [w for w in want if w not in set(got)][:2]
        return [f"{len(got)} rows, want {len(want)}; extra {extra} lacking {lacking}"]
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return [f"{len(wrong)} of {len(want)} differ: got {g} want {w}" for g, w in wrong[:2]]
