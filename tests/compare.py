"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(frame, con, sql: str) -> list[str]:
    """Empty when row count, column names and all values agree exactly."""
    left_columns, left = frame.columns, [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    right_columns = [d[0] for d in cursor.description]
    right = cursor.fetchall()
    if sorted(left_columns) != sorted(right_columns):
        return [f"columns {sorted(left_columns)} != {sorted(right_columns)}"]
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}"]
    a, b = _rows(left_columns, left), _rows(right_columns, right)
    return [f"{x} != {y}" for x, y in zip(a, b) if x != y][:3]
