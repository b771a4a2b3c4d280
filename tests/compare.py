"""Compare a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from tidemark.sources.tables import SCHEMAS


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime | datetime.date):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    cursor = con.execute(sql)
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    ours = normal(df.columns, df.collect())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} <> {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} <> {len(theirs[1])}"
    if not ours[1]:
        return "both sides are empty"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1], strict=True) if [(type(x), x) for x in a] != [(type(x), x) for x in b]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
