"""Run a registered query and its SQL twin and compare the results as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(_cell(row[n]) for n in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    found = bag(df.columns, df.collect())
    expected = bag(expected_columns, result.fetchall())
    if found == expected:
        return None
    more, less = list((found - expected).items()), list((expected - found).items())
    return f"{sum(found.values())} vs {sum(expected.values())} rows; only Spark {more[:2]}; only SQL {less[:2]}"
