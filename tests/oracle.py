"""Run a query on Spark and its SQL twin in DuckDB and compare rows as sets with repeats."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return value
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(columns, records, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    left_cols, left = rows_of(columns, records)
    rel = con.sql(sql)
    right_cols, right = rows_of(rel.columns, rel.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} vs {right_cols}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            kinds = [(type(x).__name__, type(y).__name__) for x, y in zip(a, b)]
            return f"row {str(a)[:300]} vs {str(b)[:300]} {kinds}"
    return None
