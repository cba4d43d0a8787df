"""Compare a Spark result with the SQL counterpart run by DuckDB."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=lambda row: [(v is None, str(v)) for v in row])


def kinds(names, rows):
    """Python types per column, to catch an integer against a float."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [{type(row[i]).__name__ for row in rows if row[i] is not None} for i in order]


def differences(df, connection, sql) -> list[str]:
    spark_rows = [tuple(row) for row in df.collect()]
    result = connection.execute(sql)
    sql_names = [column[0] for column in result.description]
    sql_rows = result.fetchall()
    names, left = normalised(df.columns, spark_rows)
    other, right = normalised(sql_names, sql_rows)
    if names != other:
        return [f"columns {names} against {other}"]
    problems = []
    if kinds(df.columns, spark_rows) != kinds(sql_names, sql_rows):
        problems.append(f"types {kinds(df.columns, spark_rows)} against {kinds(sql_names, sql_rows)}")
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        problems.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return problems
