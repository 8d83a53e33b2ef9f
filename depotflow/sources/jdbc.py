"""Reads from and writes to a relational database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from depotflow.sources.ranges import key_quantiles, range_predicates

FETCH_ROWS = 10_000
BATCH_ROWS = 10_000


@dataclass(frozen=True)
class Database:
    """Where a database is and how to reach it."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


def scan_options(
    database: Database,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a table scan; with a key and bounds it is split into ranges of the key."""
    options = {
        **database.properties,
        "url": database.url,
        "dbtable": table,
        "fetchsize": str(FETCH_ROWS),
        "preferTimestampNTZ": "true",
    }
    if key is not None and bounds is not None and partitions > 1:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(spark: SparkSession, database: Database, table: str, key: str) -> tuple[int, int] | None:
    """Smallest and largest key, asked of the database; None for an empty table."""
    query = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) key_bounds"
    row = spark.read.format("jdbc").options(**scan_options(database, query)).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def sampled_keys(table: str, key: str, percent: float) -> str:
    """A query for the keys of a part of the table's blocks, as PostgreSQL samples them."""
    if not 0 < percent <= 100:
        raise ValueError(f"A sample takes more than 0 and at most 100 percent, not {percent}")
    return f"(SELECT {key} FROM {table} TABLESAMPLE SYSTEM ({percent}) REPEATABLE (17)) sampled_keys"


def read_even_ranges(
    spark: SparkSession, database: Database, table: str, key: str, partitions: int, percent: float = 1.0
) -> DataFrame:
    """Scan a table in ranges of about equally many rows, cut at quantiles of a sample of its keys.

    For keys with gaps or crowded stretches, which ranges of equal width deal out unevenly.
    """
    keys = spark.read.format("jdbc").options(**scan_options(database, sampled_keys(table, key, percent))).load()
    conditions = range_predicates(key, key_quantiles(keys, key, partitions))
    options = scan_options(database, table)
    properties = {name: value for name, value in options.items() if name not in ("url", "dbtable")}
    return spark.read.jdbc(database.url, table, predicates=conditions, properties=properties)


def read_table(
    spark: SparkSession, database: Database, table: str, key: str | None = None, partitions: int = 1
) -> DataFrame:
    """Scan a table, in parallel ranges of its integer key when one is given."""
    bounds = key_bounds(spark, database, table, key) if key and partitions > 1 else None
    options = scan_options(database, table, key, bounds, partitions)
    return spark.read.format("jdbc").options(**options).load()


def write_options(database: Database, table: str, connections: int) -> dict[str, str]:
    return {
        **database.properties,
        "url": database.url,
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(connections),
    }


def table_writer(
    frame: DataFrame, database: Database, table: str, connections: int, mode: str = "overwrite"
) -> DataFrameWriter:
    """A bulk load over at most the given number of connections; call ``save`` on it."""
    return frame.write.format("jdbc").mode(mode).options(**write_options(database, table, connections))
