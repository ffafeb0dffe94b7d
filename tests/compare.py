"""Order-insensitive comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    return (value is not None, type(value).__name__, value if value is not None else 0)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = connection.execute(sql)
    sql_names = [d[0] for d in result.description]
    expected = _rows(sql_names, result.fetchall())
    names = spark_df.columns
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(set(names) ^ set(sql_names))}"
    found = _rows(names, spark_df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    if not wrong:
        return None
    columns = sorted(names)
    a, b = wrong[0]
    cells = [(c, x[-1], y[-1], x[1:2], y[1:2]) for c, x, y in zip(columns, a, b, strict=True) if x != y]
    return f"{len(wrong)} of {len(found)} rows differ, first in {cells[:6]}"
