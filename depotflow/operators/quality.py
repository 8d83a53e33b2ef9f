"""Data-quality checks as DataFrames of (check, violations).

Rules on single rows of a table share one aggregate pass. Key and reference checks group
first, so rows that repeat a value meet the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.session import release_shuffles

RESULT_COLUMNS = ["check", "violations"]


class QualityError(RuntimeError):
    """At least one check found violations."""


# --- conditions --------------------------------------------------------------------------

def any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda left, right: left | right, [F.col(name).isNull() for name in columns])


def not_accepted(column: str, values: Sequence[str]) -> Column:
    """True for a value outside the list; a missing value is not flagged."""
    return ~F.col(column).isin(*values)


def outside(column: str, low: object, high: object, null_is_violation: bool = False) -> Column:
    value = F.col(column)
    breach = (value < low) | (value > high)
    return breach | value.isNull() if null_is_violation else breach


def breaks(rule: str) -> Column:
    """True where a SQL rule is FALSE; a NULL outcome passes, as for a CHECK constraint."""
    return ~F.expr(rule)


# --- check builders ----------------------------------------------------------------------

def _single(label: str, counted: DataFrame) -> DataFrame:
    """One result row from a one-row frame holding ``violations``."""
    return counted.select(
        F.lit(label).alias("check"),
        F.coalesce(F.col("violations").cast("bigint"), F.lit(0).cast("bigint")).alias("violations"),
    )


def _unpivoted(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One result row per label from a one-row frame with a column per label."""
    pairs = [
        F.struct(F.lit(label).alias("check"), F.col(f"rule_{i}").cast("bigint").alias("violations"))
        for i, label in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def row_rules(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of any number of row conditions, in one pass over the frame."""
    labels = list(rules)
    counts = frame.agg(
        *[F.count_if(rules[label]).alias(f"rule_{i}") for i, label in enumerate(labels)]
    )
    return _unpivoted(counts, labels)


def null_keys(frame: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return row_rules(frame, {label: any_null(keys)})


def duplicated_keys(frame: DataFrame, keys: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with how often."""
    rows = frame.select(*keys)
    if ignore_nulls:
        rows = rows.filter(~any_null(keys))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def duplicate_keys(
    frame: DataFrame, keys: Sequence[str], label: str, ignore_nulls: bool = False
) -> DataFrame:
    """How many key values are duplicated."""
    duplicated = duplicated_keys(frame, keys, ignore_nulls)
    return _single(label, duplicated.agg(F.count(F.lit(1)).alias("violations")))


def unreferenced_rows(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of the child whose value is missing from the parent; NULL counts as missing."""
    known = parent.select(F.col(parent_key).alias(column))
    return child.join(known, column, "left_anti").select(*child.columns)


def missing_references(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_key: str,
    label: str,
    null_is_violation: bool,
) -> DataFrame:
    """How many child rows refer to nothing.

    Child rows are counted per value before the anti-join: a value held by very many rows
    reaches the join once, and the join reuses the grouping's partitioning.
    """
    values = child.select(column)
    if not null_is_violation:
        values = values.filter(F.col(column).isNotNull())
    per_value = values.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    orphaned = unreferenced_rows(per_value, column, parent, parent_key)
    return _single(label, orphaned.agg(F.sum("n").alias("violations")))


def missing_references_of(
    child: DataFrame,
    references: Mapping[str, tuple[str, DataFrame, str]],
    null_is_violation: bool,
) -> DataFrame:
    """The same for several columns of one child, in one pass over it and with one join.

    ``references`` maps a label to the column, its parent and the parent's key.
    """
    labels = list(references)
    columns = [references[label][0] for label in labels]
    pairs = child.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("reference"), F.col(column).alias("value"))
                    for i, column in enumerate(columns)
                ]
            )
        )
    )
    if not null_is_violation:
        pairs = pairs.filter(F.col("value").isNotNull())
    counted = pairs.groupBy("reference", "value").agg(F.count(F.lit(1)).alias("n"))
    known = all_checks(
        parent.select(F.lit(i).alias("reference"), F.col(key).alias("value"))
        for i, (_, parent, key) in enumerate(references.values())
    )
    missing = counted.join(known, ["reference", "value"], "left_anti")
    totals = missing.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("reference") == i, F.col("n"))), F.lit(0)).alias(f"rule_{i}")
            for i in range(len(labels))
        ]
    )
    return _unpivoted(totals, labels)


def empty_relation(frame: DataFrame, label: str) -> DataFrame:
    """One violation when the frame has no rows."""
    counted = frame.agg((F.count(F.lit(1)) == 0).cast("bigint").alias("violations"))
    return _single(label, counted)


def all_checks(parts: Iterable[DataFrame]) -> DataFrame:
    """Results of several checks in one frame."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def one_by_one(parts: Iterable[DataFrame]) -> DataFrame:
    """Results of several checks, run one after the other, so what one has shuffled is gone when the next begins.

    A result has one row per check, so the driver holds few.
    """
    rows, spark = [], None
    for part in parts:
        rows += part.select(*RESULT_COLUMNS).collect()
        spark = part.sparkSession
        release_shuffles(spark)
    return spark.createDataFrame(rows, "check string, violations bigint")


# --- running ------------------------------------------------------------------------------

def violated(results: DataFrame) -> list[tuple[str, int]]:
    """Checks with violations; the result holds one row per check, so it is small."""
    rows = results.filter(F.col("violations") != 0).orderBy("check").collect()
    release_shuffles(results.sparkSession)
    return [(row["check"], row["violations"]) for row in rows]


def require_clean(results: DataFrame, title: str) -> None:
    """Run every check and fail once, naming all that found violations."""
    found = violated(results)
    if found:
        raise QualityError(f"{title}: " + "; ".join(f"{label}: {count}" for label, count in found))


def require_each(parts: Iterable[tuple[str, DataFrame]]) -> None:
    """Run checks one after the other and fail at the first with violations."""
    for title, part in parts:
        require_clean(part, title)
