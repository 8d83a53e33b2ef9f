"""The stock movement ledger derived from purchasing, sales and returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.model import LEDGER_BRANCH

RECEIPTS, SALES, RETURNS = 1, 2, 3


def movement_rows(
    source: DataFrame,
    branch: int,
    key: Column,
    movement_type: str,
    quantity: Column,
    date: Column,
    reference: Column,
    warehouse: Column | None = None,
) -> DataFrame:
    """Rows of one ledger branch; the id is unique because the source key is."""
    return source.select(
        (F.lit(branch * LEDGER_BRANCH) + key).alias("movement_id"),
        (F.col("warehouse_id") if warehouse is None else warehouse).cast("bigint").alias("warehouse_id"),
        "product_id",
        F.lit(movement_type).alias("movement_type"),
        quantity.cast("int").alias("quantity"),
        date.alias("movement_date"),
        reference.alias("reference_id"),
    )


def receipts(purchase_order_items: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Units received, dated at delivery, or at the expected delivery when it is not known."""
    headers = purchase_orders.select(
        "po_id", "warehouse_id", "expected_delivery_date", "actual_delivery_date"
    )
    received = purchase_order_items.filter("received_quantity > 0").join(headers, "po_id")
    return movement_rows(
        received,
        RECEIPTS,
        F.col("po_item_id"),
        "PURCHASE_RECEIPT",
        F.col("received_quantity"),
        F.coalesce("actual_delivery_date", "expected_delivery_date"),
        X.reference_text("PO", F.col("po_id"), F.col("po_item_id")),
    )


def sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units sold by orders that were not cancelled and have a warehouse."""
    headers = orders.filter((F.col("order_status") != "CANCELLED") & F.col("warehouse_id").isNotNull())
    sold = order_items.join(headers.select("order_id", "warehouse_id", "order_date"), "order_id")
    return movement_rows(
        sold,
        SALES,
        F.col("order_item_id"),
        "SALE",
        F.col("quantity"),
        F.col("order_date"),
        X.reference_text("ORD", F.col("order_id"), F.col("order_item_id")),
    )


def returned(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Units returned, booked at the warehouse of their order."""
    headers = orders.filter(F.col("warehouse_id").isNotNull()).select("order_id", "warehouse_id")
    return movement_rows(
        returns.join(headers, "order_id"),
        RETURNS,
        F.col("return_id"),
        "RETURN",
        F.col("return_quantity"),
        F.col("return_date"),
        X.reference_text("RET", F.col("return_id")),
    )


def movement_ledger(
    purchase_order_items: DataFrame,
    purchase_orders: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
) -> DataFrame:
    """Receipts, sales and returns as movement rows. No ordering, so no global sort."""
    return (
        receipts(purchase_order_items, purchase_orders)
        .unionByName(sales(order_items, orders))
        .unionByName(returned(returns, orders))
    )


def eligible_positions(inventory: DataFrame, snapshot_date: Column, at_least: int = 10) -> DataFrame:
    """Stock positions of a day with enough units to transfer or write off."""
    return inventory.filter(
        (F.col("snapshot_date") == snapshot_date) & (F.col("closing_stock") >= at_least)
    ).select("warehouse_id", "product_id", "closing_stock")
