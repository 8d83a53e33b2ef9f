"""Comparison of query results with their SQL counterparts in DuckDB."""

from __future__ import annotations

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(root: str):
    """A connection with the raw tables of a folder as views."""
    import duckdb

    connection = duckdb.connect()
    for table in RAW_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{root}/{table}.parquet'")
    return connection


def _types(connection, relation: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {relation}").fetchall()}


def differences(spark_frame, connection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; empty when nothing does."""
    connection.register("actual_result", spark_frame.toArrow())
    try:
        connection.execute(f"CREATE OR REPLACE TEMP TABLE wanted_result AS {sql}")
        actual, wanted = _types(connection, "actual_result"), _types(connection, "wanted_result")
        if actual != wanted:
            names = actual.keys() | wanted.keys()
            return [f"{n}: {actual.get(n)} != {wanted.get(n)}" for n in sorted(names) if actual.get(n) != wanted.get(n)]
        columns = ", ".join(f'"{name}"' for name in sorted(actual))
        found = []
        for left, right in (("actual_result", "wanted_result"), ("wanted_result", "actual_result")):
            extra = f"SELECT {columns} FROM {left} EXCEPT ALL SELECT {columns} FROM {right}"
            rows = connection.execute(f"SELECT * FROM ({extra}) LIMIT 3").fetchall()
            found += [f"only in {left}: {row}" for row in rows]
        return found
    finally:
        connection.unregister("actual_result")
