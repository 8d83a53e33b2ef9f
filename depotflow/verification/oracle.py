"""SQL with the same result as each query, for an engine that is not Spark."""

from __future__ import annotations

from depotflow.model import TABLES
from depotflow.verification.oracle_views import with_views

_AS_OF = "TIMESTAMP '2010-01-01'"
_DAY = "DATE '2001-12-31'"


def _table(name: str) -> str:
    """The SQL name of an operational table; one clashes with a raw table."""
    return {"orders": "customer_orders"}.get(name, name)


def _check(label: str, count: str) -> str:
    text = label.replace("'", "''")
    return f"SELECT '{text}' AS \"check\", coalesce(({count}), 0)::BIGINT AS violations"


def _where(label: str, table: str, condition: str) -> str:
    return _check(label, f"SELECT count(*) FROM {table} WHERE {condition}")


def _duplicates(label: str, table: str, keys: str, where: str = "TRUE") -> str:
    return _check(
        label,
        f"SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {where} GROUP BY {keys} HAVING count(*) > 1) d",
    )


def _orphans(label: str, child: str, column: str, parent: str, key: str, nulls: bool) -> str:
    ignore = "" if nulls else f" AND c.{column} IS NOT NULL"
    return _check(
        label,
        f"SELECT count(*) FROM {child} c LEFT JOIN {parent} p ON p.{key} = c.{column} WHERE p.{key} IS NULL{ignore}",
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _source_references(moves: str) -> str:
    pairs = [
        ("products", "category_id", "categories"), ("inventory", "product_id", "products"),
        ("inventory", "warehouse_id", "warehouses"), ("orders", "customer_id", "customers"),
        ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"),
        ("purchase_order_items", "po_id", "purchase_orders"), ("shipments", "order_id", "orders"),
        ("returns", "order_id", "orders"),
    ]
    parts = [
        _orphans(f"{child} without {parent}", _table(child), column, _table(parent), column, True)
        for child, column, parent in pairs
    ]
    parts += [
        _orphans(f"inventory_movements without {parent}", moves, column, parent, column, True)
        for column, parent in (("product_id", "products"), ("warehouse_id", "warehouses"))
    ]
    return _union(parts)


_TYPES = (
    "('PURCHASE_RECEIPT', 'SALE', 'RETURN', 'TRANSFER_IN', 'TRANSFER_OUT', 'DAMAGE', 'ADJUSTMENT')"
)
_ANY_NULL = (
    "movement_id IS NULL OR warehouse_id IS NULL OR product_id IS NULL OR movement_type IS NULL"
    " OR quantity IS NULL OR movement_date IS NULL"
)


def _movement_checks(moves: str) -> str:
    return _union(
        [
            _where("movements with NULL required fields", moves, _ANY_NULL),
            _where("invalid movement types", moves, f"movement_type NOT IN {_TYPES}"),
            _where("non-positive quantities", moves, "quantity <= 0"),
            _where("future movement timestamps", moves, f"movement_date > {_AS_OF}"),
            _duplicates("duplicate movement ids", moves, "movement_id"),
        ]
    )


def _first_failure(moves: str) -> str:
    """Probes in the order of their cost; those behind the first hit do not run."""
    duplicates = f"SELECT movement_id FROM {moves} GROUP BY 1 HAVING count(*) > 1"
    asked = [
        ("faulty movement rows", f"{moves} WHERE {_ANY_NULL} OR movement_type NOT IN {_TYPES} OR quantity <= 0 OR movement_date > {_AS_OF}"),
        ("duplicate movement ids", f"({duplicates})"),
    ]
    for child, column, parent in (
        ("products", "category_id", "categories"), ("inventory", "product_id", "products"),
        ("inventory", "warehouse_id", "warehouses"), ("orders", "customer_id", "customers"),
        ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"),
        ("purchase_order_items", "po_id", "purchase_orders"), ("shipments", "order_id", "orders"),
        ("returns", "order_id", "orders"), ("inventory_movements", "product_id", "products"),
        ("inventory_movements", "warehouse_id", "warehouses"),
    ):
        rows = moves if child == "inventory_movements" else _table(child)
        asked.append((f"{child} without {parent}", f"{rows} c WHERE NOT EXISTS (SELECT 1 FROM {_table(parent)} p WHERE p.{column} = c.{column})"))
    counted = _union(
        [f"SELECT {place} AS place, '{label}' AS label, (SELECT count(*) FROM {rows}) AS n" for place, (label, rows) in enumerate(asked)]
    )
    return f"""
        SELECT label AS "check",
               CASE WHEN earlier > 0 THEN 'not run' WHEN n > 0 THEN 'hit' ELSE 'clean' END AS state,
               CASE WHEN earlier = 0 AND n > 0 THEN label END AS fault
        FROM (SELECT label, n,
                     coalesce(sum(n) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
              FROM ({counted}) counted) judged"""


# What the documents say: one row for every movement they justify.
_RECEIPTS = """SELECT 'PO-' || po_id || '-' || po_item_id AS ref, product_id, received_quantity AS units, warehouse_id
               FROM purchase_orders JOIN purchase_order_items USING (po_id)"""
_SALES = """SELECT 'ORD-' || order_id || '-' || order_item_id AS ref, product_id, quantity AS units, warehouse_id
            FROM customer_orders JOIN order_items USING (order_id)"""
_COMEBACKS = """SELECT 'RET-' || return_id AS ref, product_id, return_quantity AS units, warehouse_id
                FROM customer_orders JOIN returns USING (order_id)"""


def _unjustified(label: str, moves: str, kind: str, documents: str) -> str:
    """Movements of a kind for which no document stands; unknown values speak against nothing."""
    same = " AND ".join(
        f"(seen.{mine} = said.{theirs}) IS NOT FALSE"
        for mine, theirs in (("product_id", "product_id"), ("quantity", "units"), ("warehouse_id", "warehouse_id"))
    )
    return _check(
        label,
        f"""SELECT count(*) FROM (SELECT * FROM {moves} WHERE movement_type = '{kind}') seen
            ANTI JOIN ({documents}) said ON said.ref = seen.reference_id AND {same}""",
    )


def _purchase_refs(moves: str) -> str:
    return _unjustified("invalid purchase references", moves, "PURCHASE_RECEIPT", _RECEIPTS)


def _sale_refs(moves: str) -> str:
    return _unjustified("invalid sale references", moves, "SALE", _SALES)


def _return_refs(moves: str) -> str:
    return _unjustified("invalid return references", moves, "RETURN", _COMEBACKS)


def _legs(moves: str, kind: str) -> str:
    """All movements of one direction of a transfer, by reference."""
    spans = ", ".join(
        f"{how}({column}) AS {how}_{column}"
        for column in ("product_id", "quantity", "warehouse_id")
        for how in ("min", "max")
    )
    return f"""SELECT reference_id AS ref, count(*) AS n, {spans}
               FROM {moves} WHERE movement_type = '{kind}' GROUP BY reference_id"""


def _unpaired(moves: str) -> str:
    ends = ", ".join(
        f"least(a.min_{column}, b.min_{column}) AS low_{column},"
        f" greatest(a.max_{column}, b.max_{column}) AS high_{column}"
        for column in ("product_id", "quantity", "warehouse_id")
    )
    return f"""SELECT * FROM (
                   SELECT coalesce(a.ref, b.ref) AS reference_id, coalesce(a.n, 0) + coalesce(b.n, 0) AS legs,
                          coalesce(b.n, 0) AS legs_in, coalesce(a.n, 0) AS legs_out, {ends}
                   FROM ({_legs(moves, "TRANSFER_OUT")}) a
                   FULL JOIN ({_legs(moves, "TRANSFER_IN")}) b ON a.ref IS NOT DISTINCT FROM b.ref)
               WHERE (legs_in, legs_out) <> (1, 1) OR low_warehouse_id = high_warehouse_id
                  OR low_product_id < high_product_id OR low_quantity < high_quantity"""


def _transfers(moves: str) -> str:
    return _check("unpaired transfers", f"SELECT count(*) FROM ({_unpaired(moves)}) u")


def _adjustments(moves: str) -> str:
    return _where(
        "invalid adjustment references",
        moves,
        "movement_type = 'ADJUSTMENT' AND NOT regexp_full_match(reference_id, 'ADJ-(IN|OUT)-[0-9]+')",
    )


def _movement_audit(moves: str) -> str:
    return _union(
        [
            _check("empty movement table", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {moves}"),
            _movement_checks(moves),
            _orphans("orphan warehouses", moves, "warehouse_id", "warehouses", "warehouse_id", True),
            _orphans("orphan products", moves, "product_id", "products", "product_id", True),
            _purchase_refs(moves),
            _sale_refs(moves),
            _return_refs(moves),
            _transfers(moves),
            _adjustments(moves),
        ]
    )


# --- fixed values: columns (! not null, the first is the key), unique keys, references, checks --------

_COLUMNS = {
    "categories": "category_id! category_name! department!",
    "customers": "customer_id! customer_segment! city! state! country! signup_date!",
    "inventory": "inventory_id! warehouse_id! product_id! snapshot_date! opening_stock! received_quantity! sold_quantity!"
    " returned_quantity! adjustment_quantity! closing_stock! reserved_quantity!",
    "inventory_movements": "movement_id! warehouse_id! product_id! movement_type! quantity! movement_date! reference_id",
    "order_items": "order_item_id! order_id! product_id! quantity! unit_price! discount! total_amount!",
    "orders": "order_id! customer_id! warehouse_id order_date! order_status! payment_method order_value! shipping_city"
    " shipping_state promised_delivery_date actual_delivery_date",
    "products": "product_id! sku! product_name! category_id! brand unit_cost! selling_price! weight_kg reorder_point!"
    " safety_stock! supplier_id is_active! created_at!",
    "purchase_order_items": "po_item_id! po_id! product_id! ordered_quantity! received_quantity! unit_cost!",
    "purchase_orders": "po_id! supplier_id! warehouse_id! po_date! expected_delivery_date! actual_delivery_date po_status!",
    "returns": "return_id! order_id! order_item_id! product_id! return_date! return_quantity! return_reason! refund_amount!"
    " return_status!",
    "shipments": "shipment_id! order_id! warehouse_id! carrier shipment_status! shipped_at estimated_delivery_date"
    " actual_delivery_date shipping_cost!",
    "suppliers": "supplier_id! supplier_name! country! state city supplier_type rating default_lead_time_days! payment_terms"
    " is_active! created_at!",
    "warehouses": "warehouse_id! warehouse_name! city! state! country! warehouse_type capacity_units!"
    " operating_cost_per_day! latitude longitude opened_at",
}
_UNIQUE = {"categories": "category_name", "inventory": "warehouse_id, product_id, snapshot_date", "products": "sku"}
_PARENTS = {
    "inventory": "product_id>products warehouse_id>warehouses",
    "inventory_movements": "product_id>products warehouse_id>warehouses",
    "order_items": "order_id>orders product_id>products",
    "orders": "customer_id>customers warehouse_id>warehouses",
    "products": "category_id>categories supplier_id>suppliers",
    "purchase_order_items": "po_id>purchase_orders product_id>products",
    "purchase_orders": "supplier_id>suppliers warehouse_id>warehouses",
    "returns": "order_id>orders order_item_id>order_items product_id>products",
    "shipments": "order_id>orders warehouse_id>warehouses",
}
_CHECKS = """
inventory: closing_stock >= 0
inventory: opening_stock >= 0
inventory: received_quantity >= 0
inventory: reserved_quantity >= 0
inventory: returned_quantity >= 0
inventory: sold_quantity >= 0
inventory_movements: quantity > 0
inventory_movements: movement_type IN ('PURCHASE_RECEIPT', 'SALE', 'RETURN', 'TRANSFER_IN', 'TRANSFER_OUT', 'DAMAGE', 'ADJUSTMENT')
order_items: discount >= 0
order_items: unit_price >= 0
order_items: quantity > 0
order_items: total_amount >= 0
orders: order_status IN ('PLACED', 'CONFIRMED', 'PROCESSING', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')
orders: order_value >= 0
products: unit_cost >= 0
products: selling_price >= 0
products: weight_kg IS NULL OR weight_kg >= 0
products: reorder_point >= 0
products: safety_stock >= 0
purchase_order_items: ordered_quantity > 0
purchase_order_items: unit_cost >= 0
purchase_order_items: received_quantity >= 0 AND received_quantity <= ordered_quantity
purchase_orders: po_status IN ('CREATED', 'CONFIRMED', 'PARTIALLY_RECEIVED', 'RECEIVED', 'CANCELLED')
returns: refund_amount >= 0
returns: return_quantity > 0
returns: return_reason IN ('DAMAGED', 'DEFECTIVE', 'WRONG_ITEM', 'SIZE_ISSUE', 'CUSTOMER_CHANGED_MIND', 'LATE_DELIVERY', 'NOT_AS_EXPECTED')
shipments: shipment_status IN ('CREATED', 'PACKED', 'SHIPPED', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED', 'LOST', 'CANCELLED')
shipments: shipping_cost >= 0
suppliers: default_lead_time_days >= 0
suppliers: rating IS NULL OR (rating >= 0 AND rating <= 5)
warehouses: operating_cost_per_day >= 0
warehouses: capacity_units >= 0
"""
# --- end of fixed values


def _checks() -> list[tuple[str, str]]:
    return [tuple(line.split(": ", 1)) for line in _CHECKS.strip().splitlines()]


def _named(table: str) -> list[str]:
    return [name.rstrip("!") for name in _COLUMNS[table].split()]


def _required(table: str) -> list[str]:
    return [name.rstrip("!") for name in _COLUMNS[table].split() if name.endswith("!")]


def _with_copies(source: str, faults: list[tuple[str, str]], key: str) -> str:
    """A relation and, of some of its rows, a copy for each fault and one without any."""
    replaced = []
    for name in dict.fromkeys(column for column, _ in faults):
        arms = " ".join(f"WHEN {i} THEN {value}" for i, (column, value) in enumerate(faults) if column == name)
        replaced.append(f"CASE fault {arms} ELSE {name} END AS {name}")
    return f"""(SELECT * FROM {source} UNION ALL
        SELECT * EXCLUDE (fault) REPLACE ({", ".join(replaced)}) FROM {source} CROSS JOIN range({len(faults) + 1}) f(fault)
        WHERE {key} % 97 = 0 OR {key} = (SELECT min({key}) FROM {source}))"""


def _broken(table: str) -> str:
    faults = [(name, "NULL") for name in _required(table)]
    faults += [(pair.split(">")[0], "-1") for pair in _PARENTS.get(table, "").split()]
    faults += [(rule.split()[0], "'BOGUS'" if " IN (" in rule else "-1") for of, rule in _checks() if of == table]
    return _with_copies(_table(table), faults, _named(table)[0])


def _table_contract(held=_table) -> str:
    parts = [_duplicates(f"pk {t}({_named(t)[0]})", held(t), _named(t)[0], f"{_named(t)[0]} IS NOT NULL") for t in _COLUMNS]
    for table, listed in _UNIQUE.items():
        present = " AND ".join(f"{key} IS NOT NULL" for key in listed.split(", "))
        parts.append(_duplicates(f"unique {table}({listed})", held(table), listed, present))
    for table, pairs in _PARENTS.items():
        for column, parent in (pair.split(">") for pair in pairs.split()):
            known = f"SELECT {_named(parent)[0]} FROM {held(parent)} k WHERE {_named(parent)[0]} IS NOT NULL"
            parts.append(_where(f"fk {table}({column}) -> {parent}", f"{held(table)} c", f"{column} NOT IN ({known})"))
    parts += [_where(f"check {t}: {rule}", f"{held(t)} c", f"NOT ({rule})") for t, rule in _checks()]
    return _union(parts)


def _required_values(held=_table) -> str:
    return _union(
        [_where(f"not null {t}.{name}", f"{held(t)} c", f"{name} IS NULL") for t in _COLUMNS for name in _required(t)]
    )


def _staging_keys() -> str:
    parts = []
    for view, name, keys in (
        ("m1", "inventory_movements_processed", ["movement_id"]),
        ("m2", "inventory_daily_metrics", ["warehouse_id", "product_id", "movement_date"]),
        ("m3", "inventory_snapshot_enriched", ["inventory_id"]),
    ):
        parts.append(_duplicates(f"duplicate {name}", view, ", ".join(keys)))
        parts.append(_where(f"null keys {name}", view, " OR ".join(f"{key} IS NULL" for key in keys)))
    return _union(parts)


def _mart_checks() -> str:
    return _union(
        [
            _duplicates("duplicate fct_supplier_performance", "m5", "supplier_id"),
            _duplicates("duplicate fct_order_delivery_performance_daily", "m6", "delivery_date"),
            _where("null keys fct_supplier_performance", "m5", "supplier_id IS NULL"),
            _where(
                "stockout rate out of range",
                "m4",
                "stockout_rate < 0 OR stockout_rate > 1 OR stockout_rate IS NULL",
            ),
        ]
    )


_MODELS = {
    "stg_inventory_movements": "m1", "stg_inventory_daily_metrics": "m2", "stg_inventory_snapshot": "m3",
    "fct_inventory_stockout_daily": "m4", "fct_supplier_performance": "m5",
    "fct_order_delivery_performance_daily": "m6",
}


def _broken_models() -> dict[str, str]:
    wrong = {
        "m1": ("movement_id", "movement_id movement_date warehouse_id product_id movement_type",
               [("movement_type", "'BOGUS'"), ("warehouse_id", "-1"), ("product_id", "-1")]),
        "m2": ("product_id", "warehouse_id product_id movement_date movement_count", []),
        "m3": ("inventory_id", "inventory_id warehouse_id product_id snapshot_date stock_status", [("stock_status", "'BOGUS'")]),
        "m4": ("warehouse_id", "snapshot_date warehouse_id", []),
        "m5": ("supplier_id", "supplier_id supplier_name", []),
        "m6": ("delivered_order_count", "delivery_date", []),
    }
    return {
        model: _with_copies(view, [(c, "NULL") for c in wrong[view][1].split()] + wrong[view][2], wrong[view][0])
        for model, view in _MODELS.items()
    }


def _declared_tests(models: dict[str, str] = _MODELS) -> str:
    present = {
        "stg_inventory_movements": ["movement_id", "movement_date", "warehouse_id", "product_id", "movement_type"],
        "stg_inventory_daily_metrics": ["warehouse_id", "product_id", "movement_date", "movement_count"],
        "stg_inventory_snapshot": ["inventory_id", "warehouse_id", "product_id", "snapshot_date", "stock_status"],
        "fct_inventory_stockout_daily": ["snapshot_date", "warehouse_id"],
        "fct_supplier_performance": ["supplier_id", "supplier_name"],
        "fct_order_delivery_performance_daily": ["delivery_date"],
    }
    parts = [
        _where(f"not_null {model}.{column}", models[model], f"{column} IS NULL")
        for model, columns in present.items()
        for column in columns
    ]
    parts += [
        _duplicates(f"unique {model}.{column}", models[model], column, f"{column} IS NOT NULL")
        for model, column in (
            ("stg_inventory_movements", "movement_id"), ("stg_inventory_snapshot", "inventory_id"),
            ("fct_supplier_performance", "supplier_id"),
            ("fct_order_delivery_performance_daily", "delivery_date"),
        )
    ]
    parts += [
        _orphans(
            f"relationships stg_inventory_movements.{column} -> {parent}", models["stg_inventory_movements"], column, parent, column, False
        )
        for column, parent in (("warehouse_id", "warehouses"), ("product_id", "products"))
    ]
    parts += [
        _where(
            "accepted_values stg_inventory_movements.movement_type", models["stg_inventory_movements"], f"movement_type NOT IN {_TYPES}"
        ),
        _where(
            "accepted_values stg_inventory_snapshot.stock_status",
            models["stg_inventory_snapshot"],
            "stock_status NOT IN ('STOCK_OUT', 'REORDER', 'HEALTHY')",
        ),
        _duplicates("grain stg_inventory_daily_metrics", models["stg_inventory_daily_metrics"], "warehouse_id, product_id, movement_date"),
    ]
    return _union(parts)


def _counts(names: dict[str, str]) -> str:
    return _union(
        [f"SELECT '{label}' AS relation, count(*) AS row_count FROM {source}" for label, source in names.items()]
    )


_SOURCES = {name: _table(name) for name in TABLES}


def _pipeline_report() -> str:
    steps: list[tuple[int, str, dict[str, str]]] = [
        (1, "source gate", _SOURCES),
        (
            3,
            "process",
            {
                "inventory_movements_processed": "m1",
                "inventory_daily_metrics": "m2",
                "inventory_snapshot_enriched": "m3",
            },
        ),
    ]
    kpis = {
        "fct_inventory_stockout_daily": "m4",
        "fct_supplier_performance": "m5",
        "fct_order_delivery_performance_daily": "m6",
    }
    steps += [(4, "marts", kpis), (7, "publish", steps[1][2] | kpis)]
    staging = {
        "stg_inventory_movements": "m1",
        "stg_inventory_daily_metrics": "m2",
        "stg_inventory_snapshot": "m3",
    }
    steps.append((6, "analytical gate", staging | kpis))
    parts = [
        f"SELECT {number} AS step_no, '{step}' AS step, '{item}' AS item, count(*) AS value FROM {source}"
        for number, step, items in steps
        for item, source in items.items()
    ]
    parts += [
        "SELECT 2, 'data-quality gate', 'checks passed', 16::BIGINT",
        "SELECT 5, 'tests', 'tests passed', 28::BIGINT",
    ]
    return _union(parts)


_RETURNABLE = """
    SELECT o.order_id, o.order_date, o.actual_delivery_date, c.customer_segment, i.order_item_id, i.product_id,
           i.quantity, i.unit_price, i.discount, i.total_amount, k.category_name
    FROM customer_orders o
    JOIN customers c ON c.customer_id = o.customer_id
    JOIN order_items i ON i.order_id = o.order_id
    JOIN products p ON p.product_id = i.product_id
    JOIN categories k ON k.category_id = p.category_id
    WHERE o.order_status = 'DELIVERED' AND o.actual_delivery_date IS NOT NULL"""

_RETURN_RISK = f"""
    SELECT order_id, customer_segment, max_category_risk,
           least(0.15::DOUBLE, 0.07::DOUBLE * (0.75::DOUBLE + max_category_risk * 0.25::DOUBLE)
                 * CASE customer_segment WHEN 'VIP' THEN 1.15::DOUBLE WHEN 'Premium' THEN 1.08::DOUBLE
                                         ELSE 1.0::DOUBLE END) AS return_probability
    FROM (SELECT order_id, customer_segment,
                 max(CASE category_name WHEN 'Footwear' THEN 1.35::DOUBLE WHEN 'Beauty' THEN 1.20::DOUBLE
                     WHEN 'Clothing' THEN 1.30::DOUBLE WHEN 'Cameras' THEN 1.15::DOUBLE
                     WHEN 'Audio' THEN 1.15::DOUBLE WHEN 'Furniture' THEN 0.85::DOUBLE
                     WHEN 'Beverages' THEN 0.70::DOUBLE WHEN 'Grocery' THEN 0.65::DOUBLE
                     ELSE 1.0::DOUBLE END) AS max_category_risk
          FROM ({_RETURNABLE}) GROUP BY 1, 2)"""

_SHIPMENTS = "shipments s JOIN customer_orders o ON o.order_id = s.order_id"
_SENT = "('SHIPPED', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED', 'LOST')"
_PO_LINES = "purchase_order_items i JOIN purchase_orders o ON o.po_id = i.po_id"


_PUBLISHED = """
    SELECT 'inventory_movements_processed' AS dataset, 'rows' AS measure, (SELECT count(*) FROM inventory_movements) AS source,
           (SELECT count(*) FROM m1) AS processed, (SELECT count(*) FROM m1) AS published
    UNION ALL SELECT 'inventory_daily_metrics', 'movements', (SELECT count(*) FROM m1),
           (SELECT sum(movement_count)::BIGINT FROM m2), (SELECT sum(movement_count)::BIGINT FROM m2)
    UNION ALL SELECT 'inventory_snapshot_enriched', 'rows', (SELECT count(*) FROM inventory),
           (SELECT count(*) FROM m3), (SELECT count(*) FROM m3)"""


def _bodies() -> dict[str, str]:
    clean, dirty = "inventory_movements", "dirty_movements"
    bodies = {
        "m1_movements_processed": "SELECT * FROM m1",
        "m2_daily_metrics": "SELECT * FROM m2",
        "m3_snapshot_enriched": "SELECT * FROM m3",
        "m4_stockout_daily": "SELECT * FROM m4",
        "m5_supplier_performance": "SELECT * FROM m5",
        "m6_delivery_daily": "SELECT * FROM m6",
        "stg_movements": "SELECT * FROM m1",
        "stg_daily": "SELECT * FROM m2",
        "stg_snapshot": "SELECT * FROM m3",
        "typed_inventory": "SELECT * FROM inventory",
        "typed_movements": "SELECT * RENAME (movement_date AS movement_timestamp) FROM inventory_movements",
        "typed_products": "SELECT product_id, sku, product_name, category_id, reorder_point FROM products",
        "typed_warehouses": "SELECT warehouse_id, warehouse_name, city AS warehouse_city,"
                            " state AS warehouse_state FROM warehouses",
        "typed_categories": "SELECT category_id, category_name FROM categories",
        "source_gate": f"SELECT relation, row_count, 'OK' AS status FROM ({_counts(_SOURCES)})",
        "dq_referential": _source_references(clean),
        "dq_referential_dirty": _source_references(dirty),
        "dq_movements": _movement_checks(clean),
        "dq_movements_dirty": _movement_checks(dirty),
        "dq_first_failure": _first_failure(clean),
        "dq_first_failure_dirty": _first_failure(
            f"(SELECT * FROM {clean} UNION ALL SELECT * FROM {clean} WHERE movement_id % 97 = 0)"
        ),
        "scan_ranges": _union(
            [
                f"SELECT count(*) AS table_rows, count(*) AS rows_met_once, TRUE AS even, '{name}.{key}' AS scan FROM {name}"
                for name, key in (
                    ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("orders", "o_custkey"), ("part", "p_partkey"),
                )
            ]
        ),
        "dq_faulty_rows": f"""
            SELECT * FROM (
                SELECT movement_id, warehouse_id, product_id, movement_type, quantity,
                       concat_ws('; ',
                           CASE WHEN {_ANY_NULL} THEN 'movements with NULL required fields' END,
                           CASE WHEN movement_type NOT IN {_TYPES} THEN 'invalid movement types' END,
                           CASE WHEN quantity <= 0 THEN 'non-positive quantities' END,
                           CASE WHEN movement_date > {_AS_OF} THEN 'future movement timestamps' END) AS faults
                FROM {dirty}) WHERE faults <> ''""",
        "dq_duplicate_ids": f"SELECT movement_id, count(*) AS occurrences FROM {dirty}"
                            " GROUP BY 1 HAVING count(*) > 1",
        "dq_orphan_rows_products": f"SELECT m.* FROM {dirty} m LEFT JOIN products p"
                                   " ON p.product_id = m.product_id WHERE p.product_id IS NULL",
        "dq_orphan_rows_warehouses": f"SELECT m.* FROM {dirty} m LEFT JOIN warehouses w"
                                     " ON w.warehouse_id = m.warehouse_id WHERE w.warehouse_id IS NULL",
        "reference_keys": f"""
            SELECT movement_id, reference_id,
                   try_cast(split_part(reference_id, '-', 2) AS BIGINT) AS second,
                   try_cast(split_part(reference_id, '-', 3) AS BIGINT) AS third,
                   regexp_full_match(reference_id, 'PO-[0-9]+-[0-9]+') AS is_receipt
            FROM {dirty}""",
        "dq_unpaired_transfers": _unpaired(dirty),
        "movement_audit_dirty": _movement_audit(dirty),
        "dq_table_contract_dirty": _table_contract(_broken),
        "dq_required_values_dirty": _required_values(_broken),
        "dq_declared_tests_dirty": _declared_tests(_broken_models()),
        "dq_table_contract": _table_contract(),
        "dq_required_values": _required_values(),
        "dq_staging_keys": _staging_keys(),
        "dq_marts": _mart_checks(),
        "dq_reconcile": _check(
            "signed minus net quantity",
            "SELECT (SELECT coalesce(sum(signed_quantity), 0) FROM m1)"
            " - (SELECT coalesce(sum(net_quantity), 0) FROM m2)",
        ),
        "dq_declared_tests": _declared_tests(),
        "movement_type_histogram": "SELECT movement_type, count(*) AS movements FROM inventory_movements GROUP BY 1",
        "profile_customers": "SELECT count(*) AS total_customers, count(DISTINCT customer_id) AS unique_customers"
                             " FROM customers",
        "profile_products": "SELECT count(*) AS total_products, count(DISTINCT sku) AS unique_skus,"
                            " count(DISTINCT category_id) AS categories_used,"
                            " count(DISTINCT supplier_id) AS suppliers_used FROM products",
        "table_counts": _counts(_SOURCES),
        "positions_on_date": f"SELECT count(*) AS positions FROM inventory WHERE snapshot_date = {_DAY}",
        "ledger": "SELECT * FROM booked",
        "eligible_positions": "SELECT warehouse_id, product_id, closing_stock FROM inventory"
                              f" WHERE snapshot_date = {_DAY} AND closing_stock >= 10",
        "order_pricing": """
            SELECT order_id, sum(unit_price * quantity)::DECIMAL(18,2) AS gross_amount,
                   sum(round(unit_price * quantity * discount_rate, 2))::DECIMAL(18,2) AS discount,
                   sum(unit_price * quantity - round(unit_price * quantity * discount_rate, 2))::DECIMAL(18,2)
                       AS order_value
            FROM items_wide GROUP BY 1""",
        "order_value_audit": """
            SELECT order_id, order_value, items_total
            FROM customer_orders
            JOIN (SELECT o.order_id, coalesce(sum(total_amount), 0)::DECIMAL(14,2) AS items_total
                  FROM customer_orders o LEFT JOIN order_items i ON i.order_id = o.order_id GROUP BY 1)
                 USING (order_id)
            WHERE order_value IS DISTINCT FROM items_total""",
        "refund_audit": """
            SELECT return_id, order_item_id, return_quantity, refund_amount, expected_refund
            FROM (SELECT r.*, ((2 * (total_amount * 100)::BIGINT * return_quantity + quantity)
                               // (2 * quantity) / 100.0)::DECIMAL(14,2) AS expected_refund
                  FROM returns r LEFT JOIN order_items i USING (order_item_id))
            WHERE refund_amount IS DISTINCT FROM expected_refund""",
        "returnable_items": _RETURNABLE,
        "return_risk": _RETURN_RISK,
        "stock_balance": """
            SELECT inventory_id, warehouse_id, product_id, snapshot_date, closing_stock, expected_closing
            FROM (SELECT *, greatest(0, opening_stock + received_quantity - sold_quantity + returned_quantity
                                        + adjustment_quantity)::INTEGER AS expected_closing FROM inventory)
            WHERE closing_stock <> expected_closing""",
        "missing_positions": f"""
            SELECT w.warehouse_id, p.product_id FROM warehouses w, products p
            WHERE p.is_active AND NOT EXISTS (
                SELECT 1 FROM inventory i WHERE i.snapshot_date = {_DAY}
                AND i.warehouse_id = w.warehouse_id AND i.product_id = p.product_id)""",
        "shipment_consistency": _union(
            [
                _where(label, _SHIPMENTS, condition)
                for label, condition in {
                    "cancelled order with another shipment status":
                        "order_status = 'CANCELLED' AND shipment_status <> 'CANCELLED'",
                    "delivered order with another shipment status":
                        "order_status IN ('DELIVERED', 'RETURNED') AND shipment_status <> 'DELIVERED'",
                    "shipping date missing": f"shipment_status IN {_SENT} AND shipped_at IS NULL",
                    "shipping date too early": f"shipment_status NOT IN {_SENT} AND shipped_at IS NOT NULL",
                    "delivery date missing":
                        "shipment_status = 'DELIVERED' AND s.actual_delivery_date IS NULL",
                    "delivery date without delivery":
                        "shipment_status <> 'DELIVERED' AND s.actual_delivery_date IS NOT NULL",
                    "delivered before shipped": "s.actual_delivery_date < shipped_at",
                }.items()
            ]
        ),
        "po_consistency": _union(
            [
                _where("received order not received in full", _PO_LINES,
                       "po_status = 'RECEIVED' AND received_quantity <> ordered_quantity"),
                _where("partial receipt out of range", _PO_LINES,
                       "po_status = 'PARTIALLY_RECEIVED'"
                       " AND (received_quantity < 1 OR received_quantity >= ordered_quantity)"),
                _where("units received on another status", _PO_LINES,
                       "po_status NOT IN ('RECEIVED', 'PARTIALLY_RECEIVED') AND received_quantity <> 0"),
                _where("delivery date missing", "purchase_orders",
                       "po_status IN ('RECEIVED', 'PARTIALLY_RECEIVED') AND actual_delivery_date IS NULL"),
                _where("delivery date without receipt", "purchase_orders",
                       "po_status NOT IN ('RECEIVED', 'PARTIALLY_RECEIVED') AND actual_delivery_date IS NOT NULL"),
            ]
        ),
        "po_receipt_deviations": f"""
            SELECT po_item_id, i.po_id, product_id, ordered_quantity, received_quantity FROM {_PO_LINES}
            WHERE po_status = 'RECEIVED' AND received_quantity <> ordered_quantity""",
        "po_cost_band": """
            SELECT po_item_id, po_id, product_id, supplier_id, unit_cost, product_cost, cost_factor
            FROM (SELECT i.*, o.supplier_id, p.unit_cost AS product_cost,
                         CASE WHEN s.supplier_id IS NOT NULL
                              THEN (1.06 - 0.01 * coalesce(nullif(s.rating, 0), 3))::DECIMAL(6,4) END AS cost_factor
                  FROM purchase_order_items i
                  LEFT JOIN purchase_orders o ON o.po_id = i.po_id
                  LEFT JOIN products p ON p.product_id = i.product_id
                  LEFT JOIN suppliers s ON s.supplier_id = o.supplier_id)
            WHERE (abs(unit_cost - product_cost * cost_factor) <= product_cost * 0.02 + 0.01) IS NOT TRUE""",
        "supplier_tiers": """
            SELECT CASE WHEN rating >= 4.2 THEN 'GOOD' WHEN rating >= 3.2 THEN 'AVERAGE' ELSE 'PROBLEM' END AS tier,
                   count(*) AS suppliers
            FROM suppliers GROUP BY 1""",
        "supplier_assortment": """
            SELECT supplier_id, coalesce(n, 0) AS own_products,
                   coalesce(n, (SELECT count(*) FROM products WHERE is_active)) AS selectable_products,
                   n IS NULL AS falls_back
            FROM suppliers
            LEFT JOIN (SELECT supplier_id AS sid, count(*) AS n FROM products WHERE is_active GROUP BY 1)
                   ON sid = supplier_id
            WHERE is_active""",
        "insert_if_absent": """
            SELECT warehouse_id, product_id, min(movement_date)::DATE AS since, 'ledger' AS origin
            FROM inventory_movements GROUP BY 1, 2
            UNION ALL
            SELECT warehouse_id, product_id, min(snapshot_date) AS since, 'snapshot'
            FROM inventory i
            WHERE NOT EXISTS (SELECT 1 FROM inventory_movements m
                              WHERE m.warehouse_id = i.warehouse_id AND m.product_id = i.product_id)
            GROUP BY 1, 2""",
        "load_absent_twice": """
            SELECT warehouse_id, product_id, min(movement_date)::DATE AS since, 'ledger' AS origin
            FROM inventory_movements GROUP BY 1, 2
            UNION ALL
            SELECT warehouse_id, product_id, min(snapshot_date) AS since, 'snapshot'
            FROM inventory i
            WHERE NOT EXISTS (SELECT 1 FROM inventory_movements m
                              WHERE m.warehouse_id = i.warehouse_id AND m.product_id = i.product_id)
            GROUP BY 1, 2""",
        "parquet_roundtrip": "SELECT * FROM m1",
        "tsv_roundtrip": f"SELECT * FROM {dirty}",
        "publish_roundtrip": "SELECT * FROM m2",
        "published_counts": _counts(
            {
                "inventory_movements_processed": "m1",
                "inventory_daily_metrics": "m2",
                "inventory_snapshot_enriched": "m3",
                "source_inventory_movements": "inventory_movements",
            }
        ),
        "dq_published_counts": f"SELECT *, abs(processed - source) + abs(published - processed) AS difference FROM ({_PUBLISHED}) c",
        "dq_published_counts_dirty": """
            SELECT 'inventory_movements_processed' AS dataset, 'rows' AS measure, n AS source, doubled AS processed,
                   doubled AS published, doubled - n AS difference
            FROM (SELECT count(*) AS n, count(*) + count(*) FILTER (product_id = (SELECT min(product_id) FROM products)) AS doubled
                  FROM inventory_movements)""",
        "dq_leftover_runs": """
            SELECT owner, state, n AS rows FROM (SELECT count(*) AS n FROM m2) CROSS JOIN (VALUES ('crashed', 'leftover'), ('other', 'in flight')) v(owner, state)""",
        "dq_changed_partitions": """
            SELECT 'inventory_daily_metrics' AS dataset, 'movement_year=1996/movement_month=11' AS partition,
                   count(*) AS committed_rows, count(*) + count(*) FILTER (product_id % 2 = 0) AS rows
            FROM m2 WHERE movement_year = 1996 AND movement_month = 11 HAVING count(*) FILTER (product_id % 2 = 0) > 0""",
        "partition_replace": """
            SELECT * REPLACE (CASE WHEN movement_year = 1996 AND movement_month = 11 THEN net_quantity + 1000
                                   ELSE net_quantity END AS net_quantity) FROM m2""",
        "sql_views": """
            SELECT state, stock_status, count(*) AS positions, sum(available_stock)::BIGINT AS available_units
            FROM m3 JOIN warehouses USING (warehouse_id) GROUP BY 1, 2""",
        "pipeline_report": _pipeline_report(),
    }
    for name, build in {
        "dq_purchase_refs": _purchase_refs,
        "dq_sale_refs": _sale_refs,
        "dq_return_refs": _return_refs,
        "dq_transfers": _transfers,
        "dq_adjustments": _adjustments,
    }.items():
        bodies[name] = build(clean)
        bodies[f"{name}_dirty"] = build(dirty)
    return bodies


def all_oracles() -> dict[str, str]:
    return {name: with_views(body) for name, body in _bodies().items()}
