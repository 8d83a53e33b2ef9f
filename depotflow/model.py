"""The operational data model and the output contracts, as data.

Thirteen tables with their types, keys, references and value rules, plus the contracts of
the three published datasets. Everything that validates data reads it from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------

MOVEMENT_TYPES = (
    "PURCHASE_RECEIPT", "SALE", "RETURN", "TRANSFER_IN", "TRANSFER_OUT", "DAMAGE", "ADJUSTMENT",
)
INBOUND_TYPES = ("PURCHASE_RECEIPT", "RETURN", "TRANSFER_IN")
OUTBOUND_TYPES = ("SALE", "DAMAGE", "TRANSFER_OUT")
ORDER_STATUSES = (
    "PLACED", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED",
)
PO_STATUSES = ("CREATED", "CONFIRMED", "PARTIALLY_RECEIVED", "RECEIVED", "CANCELLED")
RETURN_REASONS = (
    "DAMAGED", "DEFECTIVE", "WRONG_ITEM", "SIZE_ISSUE", "CUSTOMER_CHANGED_MIND",
    "LATE_DELIVERY", "NOT_AS_EXPECTED",
)
SHIPMENT_STATUSES = (
    "CREATED", "PACKED", "SHIPPED", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "LOST",
    "CANCELLED",
)
STOCK_STATUSES = ("STOCK_OUT", "REORDER", "HEALTHY")

# Shape of a movement's reference per movement type.
RECEIPT_REFERENCE = r"^PO-[0-9]+-[0-9]+\z"
SALE_REFERENCE = r"^ORD-[0-9]+-[0-9]+\z"
RETURN_REFERENCE = r"^RET-[0-9]+\z"
ADJUSTMENT_REFERENCE = r"^ADJ-(IN|OUT)-[0-9]+\z"

# Movement ids are branch * LEDGER_BRANCH + source key.
LEDGER_BRANCH = 10**15

# --- schemas ----------------------------------------------------------------------------


def _type(text: str) -> T.DataType:
    if text.startswith("decimal"):
        precision, scale = text[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return {
        "long": T.LongType(),
        "int": T.IntegerType(),
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp": T.TimestampNTZType(),
    }[text]


def _schema(spec: str) -> T.StructType:
    """Schema from ``name type, name type!`` where ``!`` marks a required column."""
    fields = []
    for part in spec.replace("\n", " ").split(";"):
        if not part.strip():
            continue
        name, kind = part.split()
        fields.append(T.StructField(name, _type(kind.rstrip("!")), not kind.endswith("!")))
    return T.StructType(fields)


TABLES: dict[str, T.StructType] = {
    "categories": _schema("category_id long!; category_name string!; department string!"),
    "customers": _schema(
        "customer_id long!; customer_segment string!; city string!; state string!;"
        "country string!; signup_date date!"
    ),
    "inventory": _schema(
        "inventory_id long!; warehouse_id long!; product_id long!; snapshot_date date!;"
        "opening_stock int!; received_quantity int!; sold_quantity int!; returned_quantity int!;"
        "adjustment_quantity int!; closing_stock int!; reserved_quantity int!"
    ),
    "inventory_movements": _schema(
        "movement_id long!; warehouse_id long!; product_id long!; movement_type string!;"
        "quantity int!; movement_date timestamp!; reference_id string"
    ),
    "order_items": _schema(
        "order_item_id long!; order_id long!; product_id long!; quantity int!;"
        "unit_price decimal(12,2)!; discount decimal(12,2)!; total_amount decimal(14,2)!"
    ),
    "orders": _schema(
        "order_id long!; customer_id long!; warehouse_id long; order_date timestamp!;"
        "order_status string!; payment_method string; order_value decimal(14,2)!;"
        "shipping_city string; shipping_state string; promised_delivery_date timestamp;"
        "actual_delivery_date timestamp"
    ),
    "products": _schema(
        "product_id long!; sku string!; product_name string!; category_id long!; brand string;"
        "unit_cost decimal(12,2)!; selling_price decimal(12,2)!; weight_kg decimal(10,2);"
        "reorder_point int!; safety_stock int!; supplier_id long; is_active boolean!;"
        "created_at timestamp!"
    ),
    "purchase_order_items": _schema(
        "po_item_id long!; po_id long!; product_id long!; ordered_quantity int!;"
        "received_quantity int!; unit_cost decimal(12,2)!"
    ),
    "purchase_orders": _schema(
        "po_id long!; supplier_id long!; warehouse_id long!; po_date timestamp!;"
        "expected_delivery_date timestamp!; actual_delivery_date timestamp; po_status string!"
    ),
    "returns": _schema(
        "return_id long!; order_id long!; order_item_id long!; product_id long!;"
        "return_date timestamp!; return_quantity int!; return_reason string!;"
        "refund_amount decimal(14,2)!; return_status string!"
    ),
    "shipments": _schema(
        "shipment_id long!; order_id long!; warehouse_id long!; carrier string;"
        "shipment_status string!; shipped_at timestamp; estimated_delivery_date timestamp;"
        "actual_delivery_date timestamp; shipping_cost decimal(12,2)!"
    ),
    "suppliers": _schema(
        "supplier_id long!; supplier_name string!; country string!; state string; city string;"
        "supplier_type string; rating decimal(3,2); default_lead_time_days int!;"
        "payment_terms string; is_active boolean!; created_at timestamp!"
    ),
    "warehouses": _schema(
        "warehouse_id long!; warehouse_name string!; city string!; state string!;"
        "country string!; warehouse_type string; capacity_units long!;"
        "operating_cost_per_day decimal(12,2)!; latitude decimal(9,6); longitude decimal(9,6);"
        "opened_at date"
    ),
}

# Tables that must hold rows before a run starts.
NON_EMPTY_TABLES = (
    "products", "inventory", "orders", "purchase_orders", "shipments", "returns",
    "inventory_movements",
)

# --- keys, references, value rules --------------------------------------------------------

PRIMARY_KEYS = {
    "categories": "category_id",
    "customers": "customer_id",
    "inventory": "inventory_id",
    "inventory_movements": "movement_id",
    "order_items": "order_item_id",
    "orders": "order_id",
    "products": "product_id",
    "purchase_order_items": "po_item_id",
    "purchase_orders": "po_id",
    "returns": "return_id",
    "shipments": "shipment_id",
    "suppliers": "supplier_id",
    "warehouses": "warehouse_id",
}

UNIQUE_KEYS = (
    ("categories", ("category_name",)),
    ("inventory", ("warehouse_id", "product_id", "snapshot_date")),
    ("products", ("sku",)),
)


@dataclass(frozen=True)
class Reference:
    """Column ``column`` of ``child`` names a row of ``parent`` by its primary key."""

    child: str
    column: str
    parent: str

    @property
    def parent_key(self) -> str:
        return PRIMARY_KEYS[self.parent]


REFERENCES = (
    Reference("inventory", "product_id", "products"),
    Reference("inventory", "warehouse_id", "warehouses"),
    Reference("inventory_movements", "product_id", "products"),
    Reference("inventory_movements", "warehouse_id", "warehouses"),
    Reference("order_items", "order_id", "orders"),
    Reference("order_items", "product_id", "products"),
    Reference("orders", "customer_id", "customers"),
    Reference("orders", "warehouse_id", "warehouses"),
    Reference("products", "category_id", "categories"),
    Reference("products", "supplier_id", "suppliers"),
    Reference("purchase_order_items", "po_id", "purchase_orders"),
    Reference("purchase_order_items", "product_id", "products"),
    Reference("purchase_orders", "supplier_id", "suppliers"),
    Reference("purchase_orders", "warehouse_id", "warehouses"),
    Reference("returns", "order_id", "orders"),
    Reference("returns", "order_item_id", "order_items"),
    Reference("returns", "product_id", "products"),
    Reference("shipments", "order_id", "orders"),
    Reference("shipments", "warehouse_id", "warehouses"),
)


def one_of(column: str, values: tuple[str, ...]) -> str:
    """``column IN (...)`` as SQL text."""
    return f"{column} IN ({', '.join(repr(value) for value in values)})"


# A row breaks a rule only when the expression is FALSE; NULL passes.
VALUE_RULES: dict[str, tuple[str, ...]] = {
    "inventory": (
        "closing_stock >= 0",
        "opening_stock >= 0",
        "received_quantity >= 0",
        "reserved_quantity >= 0",
        "returned_quantity >= 0",
        "sold_quantity >= 0",
    ),
    "inventory_movements": ("quantity > 0", one_of("movement_type", MOVEMENT_TYPES)),
    "order_items": ("discount >= 0", "unit_price >= 0", "quantity > 0", "total_amount >= 0"),
    "orders": (one_of("order_status", ORDER_STATUSES), "order_value >= 0"),
    "products": (
        "unit_cost >= 0",
        "selling_price >= 0",
        "weight_kg IS NULL OR weight_kg >= 0",
        "reorder_point >= 0",
        "safety_stock >= 0",
    ),
    "purchase_order_items": (
        "ordered_quantity > 0",
        "unit_cost >= 0",
        "received_quantity >= 0 AND received_quantity <= ordered_quantity",
    ),
    "purchase_orders": (one_of("po_status", PO_STATUSES),),
    "returns": (
        "refund_amount >= 0",
        "return_quantity > 0",
        one_of("return_reason", RETURN_REASONS),
    ),
    "shipments": (one_of("shipment_status", SHIPMENT_STATUSES), "shipping_cost >= 0"),
    "suppliers": ("default_lead_time_days >= 0", "rating IS NULL OR (rating >= 0 AND rating <= 5)"),
    "warehouses": ("operating_cost_per_day >= 0", "capacity_units >= 0"),
}

# --- published datasets -------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    """Exact column set and types, key and directory partitioning of a published dataset."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


MOVEMENTS_PROCESSED = Contract(
    "inventory_movements_processed",
    _schema(
        "movement_id long; movement_date date; movement_timestamp timestamp; movement_year int;"
        "movement_month int; movement_week int; movement_type string; movement_direction string;"
        "quantity int; signed_quantity int; reference_id string; warehouse_id long;"
        "warehouse_name string; warehouse_city string; warehouse_state string; product_id long;"
        "sku string; product_name string; category_id long; category_name string"
    ),
    ("movement_id",),
    ("movement_year", "movement_month"),
)

DAILY_METRICS = Contract(
    "inventory_daily_metrics",
    _schema(
        "warehouse_id long; warehouse_name string; product_id long; sku string;"
        "product_name string; category_id long; category_name string; movement_date date;"
        "movement_year int; movement_month int; inbound_quantity long; outbound_quantity long;"
        "net_quantity long; movement_count long"
    ),
    ("warehouse_id", "product_id", "movement_date"),
    ("movement_year", "movement_month"),
)

SNAPSHOT_ENRICHED = Contract(
    "inventory_snapshot_enriched",
    _schema(
        "inventory_id long; warehouse_id long; product_id long; snapshot_date date;"
        "opening_stock int; received_quantity int; sold_quantity int; returned_quantity int;"
        "adjustment_quantity int; closing_stock int; reserved_quantity int; sku string;"
        "product_name string; category_id long; reorder_point int; category_name string;"
        "warehouse_name string; warehouse_city string; warehouse_state string;"
        "snapshot_year int; snapshot_month int; available_stock int; stock_status string"
    ),
    ("inventory_id",),
    ("snapshot_year", "snapshot_month"),
)

CONTRACTS = {c.name: c for c in (MOVEMENTS_PROCESSED, DAILY_METRICS, SNAPSHOT_ENRICHED)}
