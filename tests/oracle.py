"""Comparing a Spark result with its SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("float", value)
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.isoformat())
    return (type(value).__name__, value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_value(row[i]) for i in order) for row in rows], key=repr)


def differences(df, connection, sql: str) -> str | None:
    """None when names, types and values agree, else what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    want = _rows(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{sorted(names)}: {mine} != {theirs}"
    return None
