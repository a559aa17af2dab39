"""Compare two result frames regardless of row order."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if value != value else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_by_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both have the same columns and rows, else what differs."""
    cursor = connection.execute(sql)
    want_columns = [column[0] for column in cursor.description]
    want = rows_by_name(want_columns, cursor.fetchall())
    got = rows_by_name(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if sorted(want_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    unequal = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(unequal)} of {len(got)} rows differ, first {unequal[0]}" if unequal else None
