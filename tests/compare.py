"""Exact comparison of a Spark result with its reference SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
            )
    return connection


def kind(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, dt.datetime):
        return "timestamp"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [
        "|".join(f"{kind(row[i])}:{row[i]!r}" for i in order) for row in rows
    ]
    return [columns[i] for i in order], sorted(lines)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    left = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    right = canonical([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left[1])} rows, first {wrong[0][0]} / {wrong[0][1]}"
    return None
