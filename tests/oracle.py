"""Run a registered query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

from ledgerloom.sources.fixtures import RAW_TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in RAW_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def compare(columns: list[str], rows: list, other_columns: list[str], other_rows: list) -> str:
    """Empty if both results hold the same rows, else what differs."""
    if sorted(columns) != sorted(other_columns):
        return f"columns {sorted(columns)} against {sorted(other_columns)}"
    order = sorted(columns)

    def bag(names, data):
        places = [names.index(c) for c in order]
        return Counter(tuple(_plain(row[i]) for i in places) for row in data)

    left, right = bag(columns, rows), bag(other_columns, other_rows)
    if left == right:
        return ""
    return (
        f"{len(rows)} against {len(other_rows)} rows; columns {order}\n"
        f"only Spark: {list((left - right).items())[:3]}\nonly DuckDB: {list((right - left).items())[:3]}"
    )
