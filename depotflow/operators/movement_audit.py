"""Checks of movements against the documents they refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.model import (
    ADJUSTMENT_REFERENCE,
    RECEIPT_REFERENCE,
    RETURN_REFERENCE,
    SALE_REFERENCE,
)
from depotflow.operators import quality as Q

# Spread of movements without a usable reference over join partitions.
_NULL_SPREAD = 1_000_003


def _documents(lines: DataFrame, headers: DataFrame, line_key: str, header_key: str, quantity: str) -> DataFrame:
    """Document lines with what a movement made from them must say."""
    header = headers.select(
        F.col(header_key).alias("header_id"),
        F.col("warehouse_id").alias("document_warehouse"),
        F.lit(True).alias("header_found"),
    )
    return lines.select(
        F.col(line_key).alias("document_id"),
        F.col(header_key).alias("header_id"),
        F.col("product_id").alias("document_product"),
        F.col(quantity).alias("document_quantity"),
        F.lit(True).alias("line_found"),
    ).join(header, "header_id", "left")


def _against_documents(
    movements: DataFrame,
    documents: DataFrame,
    movement_type: str,
    pattern: str,
    line_part: int,
    header_part: int | None,
) -> DataFrame:
    """Movements of a type beside their document, with ``invalid`` saying they disagree.

    A movement whose reference gives no key still needs its row. Its join key becomes a
    spread of negative numbers instead of NULL, so such rows do not gather in one task;
    ``well_formed`` decides on them, whatever they meet in the join.
    """
    reference = F.col("reference_id")
    parsed = movements.filter(F.col("movement_type") == movement_type).select(
        "movement_id",
        "warehouse_id",
        "product_id",
        "quantity",
        "reference_id",
        F.coalesce(reference.rlike(pattern), F.lit(False)).alias("shaped"),
        X.reference_part(reference, line_part).alias("line_ref"),
        *([X.reference_part(reference, header_part).alias("header_ref")] if header_part else []),
    )
    usable = F.col("shaped") & F.col("line_ref").isNotNull()
    keyed = parsed.withColumns(
        {
            "well_formed": usable,
            "document_id": F.when(usable, F.col("line_ref")).otherwise(
                -1 - F.pmod(F.xxhash64("movement_id"), F.lit(_NULL_SPREAD))
            ),
        }
    )
    disagrees = [
        ~F.col("well_formed"),
        F.col("line_found").isNull(),
        F.col("header_id").isNull(),
        F.col("header_found").isNull(),
        F.col("document_product") != F.col("product_id"),
        F.col("document_quantity") != F.col("quantity"),
        F.col("document_warehouse") != F.col("warehouse_id"),
    ]
    if header_part:
        disagrees += [F.col("header_ref").isNull(), F.col("header_id") != F.col("header_ref")]
    invalid = disagrees[0]
    for condition in disagrees[1:]:
        invalid = invalid | F.coalesce(condition, F.lit(False))
    return keyed.join(documents, "document_id", "left").withColumn("invalid", invalid)


def _count_invalid(compared: DataFrame, label: str) -> DataFrame:
    return Q.row_rules(compared, {label: F.col("invalid")})


def purchase_reference_check(
    movements: DataFrame, purchase_order_items: DataFrame, purchase_orders: DataFrame
) -> DataFrame:
    """Receipts whose reference is malformed or disagrees with the purchase order."""
    documents = _documents(
        purchase_order_items, purchase_orders, "po_item_id", "po_id", "received_quantity"
    )
    compared = _against_documents(movements, documents, "PURCHASE_RECEIPT", RECEIPT_REFERENCE, 3, 2)
    return _count_invalid(compared, "invalid purchase references")


def sale_reference_check(movements: DataFrame, order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales whose reference is malformed or disagrees with the order."""
    documents = _documents(order_items, orders, "order_item_id", "order_id", "quantity")
    compared = _against_documents(movements, documents, "SALE", SALE_REFERENCE, 3, 2)
    return _count_invalid(compared, "invalid sale references")


def return_reference_check(movements: DataFrame, returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Returns whose reference is malformed or disagrees with the return and its order."""
    documents = _documents(returns, orders, "return_id", "order_id", "return_quantity")
    compared = _against_documents(movements, documents, "RETURN", RETURN_REFERENCE, 2, None)
    return _count_invalid(compared, "invalid return references")


def unpaired_transfers(movements: DataFrame) -> DataFrame:
    """Transfer references that are not one row out and one row in of the same goods."""
    kind = F.col("movement_type")
    grouped = (
        movements.filter(kind.isin("TRANSFER_IN", "TRANSFER_OUT"))
        .groupBy("reference_id")
        .agg(
            F.count(F.lit(1)).alias("legs"),
            F.count_if(kind == "TRANSFER_IN").alias("legs_in"),
            F.count_if(kind == "TRANSFER_OUT").alias("legs_out"),
            *[
                function(name).alias(f"{prefix}_{name}")
                for name in ("product_id", "quantity", "warehouse_id")
                for prefix, function in (("low", F.min), ("high", F.max))
            ],
        )
    )
    return grouped.filter(
        (F.col("legs") != 2)
        | (F.col("legs_in") != 1)
        | (F.col("legs_out") != 1)
        | (F.col("low_product_id") != F.col("high_product_id"))
        | (F.col("low_quantity") != F.col("high_quantity"))
        | (F.col("low_warehouse_id") == F.col("high_warehouse_id"))
    )


def transfer_check(movements: DataFrame) -> DataFrame:
    counted = unpaired_transfers(movements).agg(F.count(F.lit(1)).alias("violations"))
    return counted.select(F.lit("unpaired transfers").alias("check"), "violations")


def adjustment_check(movements: DataFrame) -> DataFrame:
    """Adjustments with a malformed reference; a missing one is accepted."""
    malformed = (F.col("movement_type") == "ADJUSTMENT") & ~F.col("reference_id").rlike(
        ADJUSTMENT_REFERENCE
    )
    return Q.row_rules(movements, {"invalid adjustment references": malformed})
