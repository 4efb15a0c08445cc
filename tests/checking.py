"""Compare a Spark result with a DuckDB result: columns, row count and values, in any order."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value) -> str:
    return repr(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(found)} rows differ, first {wrong[:2]}"
    return None
