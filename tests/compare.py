"""Compare a Spark result with DuckDB's, whatever the order of the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_df, connection, sql: str) -> str | None:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = normal(names, result.fetchall())
    actual = normal(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} but SQL has {sorted(names)}"
    if len(expected) != len(actual):
        return f"{len(actual)} rows but SQL has {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"{sorted(names)}\n got {got}\nwant {want}"
    return None
