"""Compare Spark queries with DuckDB on the same parquet tables, order-insensitively."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "float", "nan"
    return _kind(value), value


def as_counter(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"
    expected = as_counter(columns, found.fetchall())
    actual = as_counter(spark_df.columns, spark_df.collect())
    if not expected:
        return "no rows"
    if actual == expected:
        return None
    only_spark, only_duck = actual - expected, expected - actual
    return (f"{sum(actual.values())} vs {sum(expected.values())} rows; only Spark "
            f"{list(only_spark)[:2]}; only DuckDB {list(only_duck)[:2]}")
