"""Run a registered query and its comparison SQL, and compare the rows exactly."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(type(value)), value) if not isinstance(value, list) else
                 (True, "list", str(value)) for value in row)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(names).collect()), key=_key)


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = (tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], sorted(rows, key=_key)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    names, ours = spark_rows(df)
    expected_names, expected = sql_rows(connection, sql)
    if names != expected_names:
        return f"columns {names} are not {expected_names}"
    if len(ours) != len(expected):
        return f"{len(ours)} rows are not {len(expected)}"
    for a, b in zip(ours, expected):
        for name, x, y in zip(names, a, b):
            same = x == y and type(x) is type(y)
            if not same and not (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)):
                return f"{name}: {x!r} is not {y!r} in {a} / {b}"
    return None if ours else "no rows"
