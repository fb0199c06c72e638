"""Compare a Spark result with DuckDB's, ignoring row and column order."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())
