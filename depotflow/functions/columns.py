"""Scalar and aggregate column expressions of the inventory domain.

All are built-in Spark expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from depotflow.model import INBOUND_TYPES, OUTBOUND_TYPES

SECONDS_PER_DAY = 86_400


# --- movements ---------------------------------------------------------------------------

def movement_direction(movement_type: Column) -> Column:
    """``inbound``, ``outbound``, or ``adjustment`` for every other or missing type."""
    return (
        F.when(movement_type.isin(*INBOUND_TYPES), F.lit("inbound"))
        .when(movement_type.isin(*OUTBOUND_TYPES), F.lit("outbound"))
        .otherwise(F.lit("adjustment"))
    )


def signed_quantity(movement_type: Column, quantity: Column) -> Column:
    """Quantity with the sign of its direction; adjustments count as zero."""
    return (
        F.when(movement_type.isin(*INBOUND_TYPES), quantity)
        .when(movement_type.isin(*OUTBOUND_TYPES), -quantity)
        .otherwise(F.lit(0))
    )


# --- stock -------------------------------------------------------------------------------

def available_stock(closing: Column, reserved: Column) -> Column:
    return closing - reserved


def stock_status(available: Column, reorder_point: Column) -> Column:
    """STOCK_OUT at zero or below, REORDER up to the reorder point, else HEALTHY."""
    return (
        F.when(available <= 0, F.lit("STOCK_OUT"))
        .when(available <= reorder_point, F.lit("REORDER"))
        .otherwise(F.lit("HEALTHY"))
    )


def balanced_stock(
    opening: Column, received: Column, sold: Column, returned: Column, adjustment: Column
) -> Column:
    """Closing stock implied by the day's flows, never below zero."""
    return F.greatest(F.lit(0), opening + received - sold + returned + adjustment)


# --- ratios, money, time -----------------------------------------------------------------

def flag_sum(condition: Column) -> Column:
    """How many rows meet the condition; NULL counts as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))


def safe_ratio(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """Decimal quotient rounded HALF_UP, NULL on a zero or missing denominator."""
    exact = numerator.cast("decimal(20,0)") / F.nullif(
        denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
    )
    return F.round(exact, scale).cast("double")


def money(amount: Column) -> Column:
    """Two decimals, HALF_UP."""
    return F.round(amount, 2)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two zone-less timestamps, microseconds kept."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("decimal(20,6)") * SECONDS_PER_DAY
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
        + F.extract(F.lit("SECOND"), gap)
    ).cast("decimal(20,6)")


def mean_elapsed_days(start: Column, end: Column, scale: int = 2) -> Column:
    """Average elapsed days of a group, rounded HALF_UP."""
    seconds = elapsed_seconds(start, end)
    divisor = F.nullif(F.count(seconds), F.lit(0)).cast("decimal(20,0)") * F.lit(SECONDS_PER_DAY)
    return F.round(F.sum(seconds) / divisor, scale).cast("double")


def shifted(timestamp: Column, days: Column | int, hours: Column | int = 0) -> Column:
    """Timestamp moved by whole days and hours."""
    as_column = lambda value: value if isinstance(value, Column) else F.lit(value)
    return timestamp + F.make_dt_interval(as_column(days).cast("int"), as_column(hours).cast("int"))


# --- references and lookups --------------------------------------------------------------

def reference_part(reference: Column, position: int) -> Column:
    """The number at a position of a dash-separated reference, NULL when it is none."""
    return F.split_part(reference, F.lit("-"), F.lit(position)).try_cast("bigint")


def reference_text(prefix: str, *keys: Column) -> Column:
    """``PREFIX-key-key``; NULL when a key is NULL."""
    parts = [F.lit(prefix)]
    for key in keys:
        parts += [F.lit("-"), key.cast("string")]
    return F.concat(*parts)


def padded_code(prefix: str, number: Column, width: int = 6) -> Column:
    """Zero-padded code such as ``SKU-000001``; longer numbers are kept whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))


def looked_up(key: Column, values: Mapping[str, object], default: object) -> Column:
    """Value of a small fixed mapping, or the default for any other key."""
    chain = None
    for name, value in values.items():
        match = key == F.lit(name)
        chain = F.when(match, F.lit(value)) if chain is None else chain.when(match, F.lit(value))
    return chain.otherwise(F.lit(default))


def clamped(value: Column, low: object | None = None, high: object | None = None) -> Column:
    """Value limited to [low, high]; NULL stays NULL, unlike plain greatest and least."""
    limited = value
    if low is not None:
        limited = F.greatest(limited, F.lit(low))
    if high is not None:
        limited = F.least(limited, F.lit(high))
    return F.when(value.isNotNull(), limited)
