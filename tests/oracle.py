"""Compare a registered query with its SQL on DuckDB, value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def spark_rows(frame) -> list[tuple]:
    names = sorted(frame.columns)
    return sorted((tuple(_plain(r[n]) for n in names) for r in frame.collect()), key=_sort_key)


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), sorted(rows, key=_sort_key)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (bytearray, bytes)):
        return bytes(value)
    return value


def _sort_key(row: tuple):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
