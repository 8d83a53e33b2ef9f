"""Joins on a key that holds a third of all rows are split, and stay exact."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from depotflow.model import TABLES
from depotflow.operators import audits as R
from depotflow.operators import inventory as I
from depotflow.operators import ledger as L
from depotflow.operators import movement_audit as A
from depotflow.operators import quality as Q

ROWS = 60_000
HOT = "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 500 END"

# Thresholds small enough for the test's rows to count as skewed, and no broadcast.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def shuffling(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def made(spark, name, count, **columns):
    """Rows of a table from expressions over a row number."""
    return spark.range(0, count, 1, 8).select(
        *[F.expr(columns.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
    )


def split_joins(frame) -> int:
    """How many joins of an executed plan read split partitions."""
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("skew=true")


@pytest.fixture()
def tables(shuffling):
    def table(name, count, **columns):
        return made(shuffling, name, count, **columns)

    return {
        "products": table("products", 500, product_id="id", sku="id", product_name="id", category_id="id % 6"),
        "warehouses": table("warehouses", 25, warehouse_id="id", warehouse_name="id", city="id", state="id"),
        "categories": table("categories", 6, category_id="id", category_name="id"),
        "movements": table(
            "inventory_movements", ROWS, movement_id="id", warehouse_id="1", product_id=HOT, quantity="1",
            movement_type="'PURCHASE_RECEIPT'", movement_date="timestamp_ntz'2024-01-01 00:00:00'",
            reference_id="CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'PO-1-7' ELSE concat('PO-1-', id) END",
        ),
        "items": table(
            "purchase_order_items", ROWS, po_item_id="id", po_id="CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END",
            product_id=HOT, ordered_quantity="1", received_quantity="1",
        ),
        "orders": table("purchase_orders", 500, po_id="id", supplier_id="id % 20", warehouse_id="1"),
    }


def test_enrichment(tables):
    dims = {name: tables[name] for name in ("products", "warehouses", "categories")}
    enriched = I.enriched_movements(tables["movements"], **dims)
    found = enriched.collect()
    assert len(found) == ROWS and all(row["sku"] == str(row["product_id"]) for row in found)
    assert split_joins(enriched) >= 1


def test_orphan_rows(tables):
    known = tables["products"].filter("product_id <> 7")
    orphans = Q.unreferenced_rows(tables["movements"], "product_id", known, "product_id")
    wanted = tables["movements"].filter("product_id = 7").count()
    assert len(orphans.collect()) == wanted > ROWS / 3
    assert split_joins(orphans) == 1
    counted = Q.missing_references(tables["movements"], "product_id", known, "product_id", "x", True)
    assert counted.first()["violations"] == wanted


def test_document_checks(tables):
    check = A.purchase_reference_check(tables["movements"], tables["items"], tables["orders"])
    found = check.collect()[0]["violations"]
    # Valid: references to item 7 where its product is the movement's, and own items of order 1.
    item_po = {i: 1 if i % 3 == 0 else i % 500 for i in range(ROWS)}
    product = {i: 7 if i % 3 == 0 else i % 500 for i in range(ROWS)}
    valid = 0
    for i in range(ROWS):
        document = {0: None, 1: 7, 2: i}[i % 3]
        valid += document is not None and item_po[document] == 1 and product[document] == product[i]
    assert found == ROWS - valid
    assert split_joins(check) >= 1


def test_ledger_and_refunds(shuffling, tables):
    receipts = L.receipts(tables["items"], tables["orders"])
    assert len(receipts.collect()) == ROWS and split_joins(receipts) == 1
    lines = made(shuffling, "order_items", ROWS, order_item_id="id", order_id="id", quantity="1", total_amount="5")
    back = made(
        shuffling, "returns", ROWS, return_id="id", order_item_id="CASE WHEN id % 3 = 0 THEN 7 ELSE id END",
        return_quantity="1", refund_amount="1",
    )
    deviations = R.refund_deviations(back, lines)
    assert len(deviations.collect()) == ROWS and split_joins(deviations) == 1
