"""Enriched movements, daily metrics, enriched stock snapshots and their staging views."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.model import DAILY_METRICS, MOVEMENTS_PROCESSED, SNAPSHOT_ENRICHED
from depotflow.operators import standardize as S

_GRAIN = ["warehouse_id", "product_id", "movement_date"]
_MEASURES = ["inbound_quantity", "outbound_quantity", "net_quantity", "movement_count"]
_DAILY_GROUP = [name for name in DAILY_METRICS.columns if name not in _MEASURES]


def with_product(facts: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Facts with the attributes of their product and the name of its category.

    Products join before categories: both are then sized by their own files, so Spark
    broadcasts what is small and shuffles on product ids only when products are not. Hot
    product ids are split by the adaptive skew join.
    """
    return facts.join(S.typed_products(products), "product_id", "left").join(
        S.typed_categories(categories), "category_id", "left"
    )


def with_warehouse(facts: DataFrame, warehouses: DataFrame) -> DataFrame:
    return facts.join(S.typed_warehouses(warehouses), "warehouse_id", "left")


def enriched_movements(
    movements: DataFrame, products: DataFrame, warehouses: DataFrame, categories: DataFrame
) -> DataFrame:
    """Every movement with product, category and warehouse names, direction and sign.

    Left joins: a movement whose product or warehouse is unknown keeps its row.
    """
    when = F.col("movement_timestamp")
    kind = F.col("movement_type")
    named = with_warehouse(with_product(S.typed_movements(movements), products, categories), warehouses)
    return (
        named.withColumns(
            {
                "movement_date": F.to_date(when),
                "movement_year": F.year(when),
                "movement_month": F.month(when),
                "movement_week": F.weekofyear(when),
                "movement_direction": X.movement_direction(kind),
                "signed_quantity": X.signed_quantity(kind, F.col("quantity")),
            }
        )
        .select(*MOVEMENTS_PROCESSED.columns)
    )


def _measures(direction: Column, signed: Column) -> list[Column]:
    quantity = F.col("quantity")
    return [
        F.sum(F.when(direction == "inbound", quantity).otherwise(0)).alias("inbound_quantity"),
        F.sum(F.when(direction == "outbound", quantity).otherwise(0)).alias("outbound_quantity"),
        F.sum(signed).alias("net_quantity"),
        F.count("movement_id").alias("movement_count"),
    ]


def daily_metrics(enriched: DataFrame) -> DataFrame:
    """In, out, net and count per warehouse, product and day, from enriched movements."""
    return (
        enriched.groupBy(*_DAILY_GROUP)
        .agg(*_measures(F.col("movement_direction"), F.col("signed_quantity")))
        .select(*DAILY_METRICS.columns)
    )


def daily_metrics_from_sources(
    movements: DataFrame, products: DataFrame, warehouses: DataFrame, categories: DataFrame
) -> DataFrame:
    """The same result straight from the ledger, aggregated before names are joined on.

    Only three keys and four numbers per group are shuffled. A key that a dimension holds twice
    counts as often, as in ``daily_metrics``: equal names of a key are one row and how often it is there, so
    the join yields each group once, and no aggregation over all descriptive columns has to follow.
    """
    kind = F.col("movement_type")
    totals = (
        S.typed_movements(movements)
        .withColumn("movement_date", F.to_date("movement_timestamp"))
        .groupBy(*_GRAIN)
        .agg(*_measures(X.movement_direction(kind), X.signed_quantity(kind, F.col("quantity"))))
    )
    named = (
        totals.join(_counted_rows(S.typed_products(products), "product_id", "sku", "product_name", "category_id"), "product_id", "left")
        .join(_counted_rows(S.typed_categories(categories), "category_id", "category_name"), "category_id", "left")
        .join(_counted_rows(S.typed_warehouses(warehouses), "warehouse_id", "warehouse_name"), "warehouse_id", "left")
    )
    times = reduce(mul, [F.coalesce(f"{key} rows", F.lit(1)) for key in ("product_id", "category_id", "warehouse_id")])
    return named.withColumns(
        {"movement_year": F.year("movement_date"), "movement_month": F.month("movement_date")}
        | {name: F.col(name) * times for name in _MEASURES}
    ).select(*DAILY_METRICS.columns)


def _counted_rows(dimension: DataFrame, key: str, *names: str) -> DataFrame:
    """The different rows of a dimension in these columns, and how often each is there."""
    return dimension.groupBy(key, *names).agg(F.count(F.lit(1)).alias(f"{key} rows"))


def enriched_snapshot(
    inventory: DataFrame, products: DataFrame, warehouses: DataFrame, categories: DataFrame
) -> DataFrame:
    """Every stock position with names, available stock and stock status."""
    available = X.available_stock(F.col("closing_stock"), F.col("reserved_quantity"))
    named = with_warehouse(with_product(S.typed_inventory(inventory), products, categories), warehouses)
    return (
        named.withColumns(
            {
                "snapshot_year": F.year("snapshot_date"),
                "snapshot_month": F.month("snapshot_date"),
                "available_stock": available,
                "stock_status": X.stock_status(available, F.col("reorder_point")),
            }
        )
        .select(*SNAPSHOT_ENRICHED.columns)
    )


# --- staging views: the published columns, in their published order -------------------------

def staged_movements(published: DataFrame) -> DataFrame:
    return published.select(*MOVEMENTS_PROCESSED.columns)


def staged_daily_metrics(published: DataFrame) -> DataFrame:
    return published.select(*DAILY_METRICS.columns)


def staged_snapshot(published: DataFrame) -> DataFrame:
    return published.select(*SNAPSHOT_ENRICHED.columns)
