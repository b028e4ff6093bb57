"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, row count and every value agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} != {sorted(names)}"]
    actual = _rows(result.columns, [tuple(row) for row in result.collect()])
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)}"]
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    wrong += [(a, e) for a, e in zip(actual, expected) if a == e and list(map(repr, a)) != list(map(repr, e))]
    return [f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}"] if wrong else []
