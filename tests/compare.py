"""Compare registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6)
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` if equal, else what differs first."""
    ours, cursor = df.collect(), con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    a, b = _rows(df.columns, ours), _rows(columns, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first only here: {next((x for x in a if x not in b), None)}; first only there: {next((x for x in b if x not in a), None)}"
    return next((f"{x} against {y}" for x, y in zip(a, b) if x != y), None)
