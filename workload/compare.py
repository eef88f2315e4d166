"""Run registered queries beside their SQL and compare rows, columns and types."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "VARCHAR[]": "array<string>",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A database in memory with one view per given table."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between a result and its SQL; empty when they agree."""
    expected = connection.execute(f"DESCRIBE {sql}").fetchall()
    wanted = {row[0]: _KINDS.get(row[1], row[1]) for row in expected}
    got = {name: kind.replace("timestamp_ntz", "timestamp") for name, kind in df.dtypes}
    if wanted != got:
        return [f"schema: expected {sorted(wanted.items())}, got {sorted(got.items())}"]
    right = _bag(list(wanted), connection.execute(sql).fetchall())
    left = _bag(df.columns, [tuple(row) for row in df.collect()])
    found = [f"only in Spark x{n}: {row}" for row, n in (left - right).items()]
    found += [f"only in SQL x{n}: {row}" for row, n in (right - left).items()]
    if left.total() != right.total():
        found.insert(0, f"rows: expected {right.total()}, got {left.total()}")
    return found
