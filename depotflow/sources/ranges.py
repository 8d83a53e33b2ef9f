"""Scan ranges of equal depth, from quantiles of a sample of keys.

Ranges of equal width give one task most rows where keys lie close together. Here the bounds are
quantiles, so every range holds about as many rows as any other; a key that holds more than a
range's share shares its range with less than one further share.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Quantiles are off by at most a part in so many of the sampled rows.
ACCURACY = 100_000

Bound = int | float | Decimal | date | datetime


def key_quantiles(keys: DataFrame, key: str, partitions: int, fraction: float = 1.0, seed: int = 17) -> list[Bound]:
    """Increasing inner bounds, at most ``partitions`` - 1, that cut the keys into ranges of equal depth.

    ``fraction`` of the rows are looked at. The quantiles are merged from sketches of the partitions,
    so the driver receives the bounds alone. NULL keys and equal bounds do not count; no keys, no bounds.
    """
    if partitions < 2:
        return []
    sample = keys.select(key) if fraction >= 1 else keys.select(key).sample(fraction=fraction, seed=seed)
    shares = [i / partitions for i in range(1, partitions)]
    found = sample.agg(F.percentile_approx(key, shares, ACCURACY).alias("bounds")).first()["bounds"]
    return sorted(set(found or []))


def _literal(value: Bound) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def range_predicates(key: str, bounds: list[Bound]) -> list[str]:
    """SQL conditions of the ranges: every row meets exactly one of them, NULL keys the first."""
    if not bounds:
        return ["1 = 1"]
    shown = [_literal(bound) for bound in bounds]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(shown, shown[1:])]
    return [f"{key} < {shown[0]} OR {key} IS NULL", *between, f"{key} >= {shown[-1]}"]


def range_depths(frame: DataFrame, key: str, bounds: list[Bound]) -> DataFrame:
    """(range_no, rows, met_once, hottest) of the ranges that hold rows, in one pass over the key column.

    ``range_no`` is the number of the condition of :func:`range_predicates` that a row meets first, ``met_once``
    counts rows that meet no other, ``hottest`` the rows of the range's most frequent key. Equal keys are counted first.
    """
    conditions = [F.coalesce(F.expr(condition), F.lit(False)) for condition in range_predicates(key, bounds)]
    number = F.coalesce(*[F.when(condition, F.lit(i)) for i, condition in enumerate(conditions)])
    met = sum((condition.cast("int") for condition in conditions), F.lit(0))
    per_key = frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(number.alias("range_no")).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(met == 1, F.col("n")).otherwise(F.lit(0))).alias("met_once"),
        F.max("n").alias("hottest"),
    )
