"""Compare a query with its SQL on the same tables, value by value."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process connection with one view per Parquet file."""
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None if they hold the same rows."""
    cursor = connection.execute(sql)
    expected_columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    actual = [tuple(row) for row in df.collect()]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns: {sorted(set(df.columns) ^ set(expected_columns))}"
    ours, theirs = _bag(df.columns, actual), _bag(expected_columns, expected)
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    wrong = sum((ours - theirs).values())
    return f"{wrong} of {len(actual)} rows ({len(expected)} expected) differ\n  {sorted(df.columns)}\n  got {extra}\n  not {missing}"
