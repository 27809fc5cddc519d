"""Compare a Spark result with DuckDB's, as sorted values with columns by name."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return str(value)


def values(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark and DuckDB names of the types results may have.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, connection, sql: str) -> str | None:
    """None when results are equal, else what differs."""
    relation = connection.sql(sql)
    ours = {name: TYPES.get(dtype, dtype) for name, dtype in spark_df.dtypes}
    theirs = {name: str(dtype) for name, dtype in zip(relation.columns, relation.types)}
    if ours != theirs:
        keys = sorted(ours.keys() | theirs.keys())
        return "schema: " + ", ".join(
            f"{k} {ours.get(k)}/{theirs.get(k)}" for k in keys if ours.get(k) != theirs.get(k)
        )
    a = values(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    b = values(relation.columns, relation.fetchall())
    if len(a) != len(b):
        return f"rows: {len(a)}/{len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"values ({sorted(ours)}): {x} / {y}"
    return None
