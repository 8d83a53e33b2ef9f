"""Typed projections of the source tables and the checks on their columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

# Output column -> (source column, type). Extra source columns are dropped here.
_PROJECTIONS: dict[str, dict[str, tuple[str, str]]] = {
    "inventory": {
        "inventory_id": ("inventory_id", "bigint"),
        "warehouse_id": ("warehouse_id", "bigint"),
        "product_id": ("product_id", "bigint"),
        "snapshot_date": ("snapshot_date", "date"),
        "opening_stock": ("opening_stock", "int"),
        "received_quantity": ("received_quantity", "int"),
        "sold_quantity": ("sold_quantity", "int"),
        "returned_quantity": ("returned_quantity", "int"),
        "adjustment_quantity": ("adjustment_quantity", "int"),
        "closing_stock": ("closing_stock", "int"),
        "reserved_quantity": ("reserved_quantity", "int"),
    },
    "inventory_movements": {
        "movement_id": ("movement_id", "bigint"),
        "warehouse_id": ("warehouse_id", "bigint"),
        "product_id": ("product_id", "bigint"),
        "movement_type": ("movement_type", "string"),
        "quantity": ("quantity", "int"),
        "movement_timestamp": ("movement_date", "timestamp_ntz"),
        "reference_id": ("reference_id", "string"),
    },
    "products": {
        "product_id": ("product_id", "bigint"),
        "sku": ("sku", "string"),
        "product_name": ("product_name", "string"),
        "category_id": ("category_id", "bigint"),
        "reorder_point": ("reorder_point", "int"),
    },
    "warehouses": {
        "warehouse_id": ("warehouse_id", "bigint"),
        "warehouse_name": ("warehouse_name", "string"),
        "warehouse_city": ("city", "string"),
        "warehouse_state": ("state", "string"),
    },
    "categories": {
        "category_id": ("category_id", "bigint"),
        "category_name": ("category_name", "string"),
    },
}

REQUIRED_COLUMNS = {
    table: {source for source, _ in columns.values()} for table, columns in _PROJECTIONS.items()
}


def missing_columns(frame: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(frame.columns))


def require_columns(frames: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]] = REQUIRED_COLUMNS) -> None:
    """Fail unless every frame has its required columns; more columns are allowed."""
    for table, columns in required.items():
        absent = missing_columns(frames[table], columns)
        if absent:
            raise RuntimeError(f"{table} is missing columns: {', '.join(absent)}")


def _typed(table: str, frame: DataFrame) -> DataFrame:
    return frame.selectExpr(
        *[f"CAST({source} AS {kind}) AS {name}" for name, (source, kind) in _PROJECTIONS[table].items()]
    )


def typed_inventory(inventory: DataFrame) -> DataFrame:
    return _typed("inventory", inventory)


def typed_movements(movements: DataFrame) -> DataFrame:
    """Movement columns in their types; the source's movement_date is a timestamp."""
    return _typed("inventory_movements", movements)


def typed_products(products: DataFrame) -> DataFrame:
    return _typed("products", products)


def typed_warehouses(warehouses: DataFrame) -> DataFrame:
    return _typed("warehouses", warehouses)


def typed_categories(categories: DataFrame) -> DataFrame:
    return _typed("categories", categories)
