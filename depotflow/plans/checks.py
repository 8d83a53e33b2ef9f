"""The declared checks: source gates, movement audits, contract rules and mart tests.

Each rule is declared once; the gates, the audits and the run all read the same lists.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.model import (
    CONTRACTS,
    MOVEMENT_TYPES,
    NON_EMPTY_TABLES,
    PRIMARY_KEYS,
    REFERENCES,
    STOCK_STATUSES,
    TABLES,
    UNIQUE_KEYS,
    VALUE_RULES,
    Contract,
)
from depotflow.operators import movement_audit as A
from depotflow.operators import probes
from depotflow.operators import profiles as P
from depotflow.operators import quality as Q
from depotflow.operators.rules import Never, Refers, Rule, Unique, compiled
from depotflow.session import stashed
from depotflow.sources.relations import Relations

# (child, column, parent): a missing reference counts even where the value is NULL.
SOURCE_REFERENCES = (
    ("products", "category_id", "categories"),
    ("inventory", "product_id", "products"),
    ("inventory", "warehouse_id", "warehouses"),
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("purchase_order_items", "po_id", "purchase_orders"),
    ("shipments", "order_id", "orders"),
    ("returns", "order_id", "orders"),
    ("inventory_movements", "product_id", "products"),
    ("inventory_movements", "warehouse_id", "warehouses"),
)

REQUIRED_MOVEMENT_FIELDS = (
    "movement_id", "warehouse_id", "product_id", "movement_type", "quantity", "movement_date",
)

# --- source gate --------------------------------------------------------------------------


def require_tables(relations: Relations, required: tuple[str, ...] = tuple(TABLES)) -> None:
    missing = relations.missing(required)
    if missing:
        raise RuntimeError("The source lacks tables: " + ", ".join(missing))


def source_counts(relations: Relations) -> DataFrame:
    """Row count of every required table and whether it may be empty."""
    counted = P.row_counts({name: relations[name] for name in TABLES}, TABLES)
    must_hold_rows = F.col("relation").isin(*NON_EMPTY_TABLES)
    return counted.withColumn(
        "status", F.when(must_hold_rows & (F.col("row_count") == 0), "EMPTY").otherwise("OK")
    )


# --- data-quality gate -----------------------------------------------------------------------


def _references(
    relations: Relations, declared: dict[str, dict[str, tuple[str, str]]], null_is_violation: bool
) -> DataFrame:
    """Missing references, one pass per child: child to label to column and parent."""
    return Q.all_checks(
        Q.missing_references_of(
            relations[child],
            {
                label: (column, relations[parent], PRIMARY_KEYS[parent])
                for label, (column, parent) in wanted.items()
            },
            null_is_violation,
        )
        for child, wanted in declared.items()
    )


def source_references(relations: Relations) -> DataFrame:
    """Rows without the row they refer to, one result per declared pair."""
    declared: dict[str, dict[str, tuple[str, str]]] = {}
    for child, column, parent in SOURCE_REFERENCES:
        declared.setdefault(child, {})[f"{child} without {parent}"] = (column, parent)
    return _references(relations, declared, null_is_violation=True)


def movement_conditions(as_of: Column) -> dict[str, Column]:
    """Faults a movement row can show by itself."""
    return {
        "movements with NULL required fields": Q.any_null(REQUIRED_MOVEMENT_FIELDS),
        "invalid movement types": Q.not_accepted("movement_type", MOVEMENT_TYPES),
        "non-positive quantities": F.col("quantity") <= 0,
        "future movement timestamps": F.col("movement_date") > as_of,
    }


def movement_checks(movements: DataFrame, as_of: Column) -> DataFrame:
    """Row faults in one pass, and duplicated ids."""
    return Q.all_checks(
        [
            Q.row_rules(movements, movement_conditions(as_of)),
            Q.duplicate_keys(movements, ["movement_id"], "duplicate movement ids"),
        ]
    )


def movement_probes(movements: DataFrame, as_of: Column) -> list[probes.Probe]:
    """The faults of :func:`movement_checks` as probes: row faults in one scan, then duplicated ids."""
    return [
        probes.repeated_keys("duplicate movement ids", movements, ["movement_id"]),
        probes.faulty_rows("faulty movement rows", movements, movement_conditions(as_of), ["movement_id", "warehouse_id", "product_id"]),
    ]


def reference_probes(relations: Relations) -> list[probes.Probe]:
    """A probe per declared pair of child and parent; the child's key is shown where the relation has it."""
    found = []
    for child, column, parent in SOURCE_REFERENCES:
        rows, key = relations[child], PRIMARY_KEYS[child]
        found.append(
            probes.orphans(
                f"{child} without {parent}",
                rows,
                column,
                relations[parent],
                PRIMARY_KEYS[parent],
                key if key in rows.columns else None,
            )
        )
    return found


def faulty_movements(movements: DataFrame, as_of: Column) -> DataFrame:
    """The movement rows with a fault of their own, and which faults they show."""
    faults = F.filter(
        F.array(*[F.when(condition, F.lit(name)) for name, condition in movement_conditions(as_of).items()]),
        lambda name: name.isNotNull(),
    )
    return (
        movements.withColumn("faults", F.array_join(faults, "; "))
        .filter(F.col("faults") != "")
        .select("movement_id", "warehouse_id", "product_id", "movement_type", "quantity", "faults")
    )


def movement_audit(relations: Relations, as_of: Column) -> DataFrame:
    """Everything known about the soundness of the movement table, document checks included.

    Movements are written once and read by each check. The checks against documents run one after the other, as
    each shuffles movements and documents anew.
    """
    moves = stashed(relations["inventory_movements"], "audited")
    held = relations.extended(inventory_movements=moves)
    orphans = {
        "orphan warehouses": ("warehouse_id", "warehouses"),
        "orphan products": ("product_id", "products"),
    }
    return Q.one_by_one(
        [
            Q.all_checks(
                [
                    Q.empty_relation(moves, "empty movement table"),
                    movement_checks(moves, as_of),
                    _references(held, {"inventory_movements": orphans}, null_is_violation=True),
                    A.transfer_check(moves),
                    A.adjustment_check(moves),
                ]
            ),
            A.purchase_reference_check(moves, relations["purchase_order_items"], relations["purchase_orders"]),
            A.sale_reference_check(moves, relations["order_items"], relations["orders"]),
            A.return_reference_check(moves, relations["returns"], relations["orders"]),
        ]
    )


# --- contracts --------------------------------------------------------------------------------


# Tables whose contract rules share a pass: those made of the same rows are together.
_RULED_TOGETHER = (
    ("inventory_movements",),
    ("order_items", "returns"),
    ("purchase_order_items", "purchase_orders"),
    ("orders", "shipments", "customers"),
    ("inventory", "products", "suppliers", "warehouses", "categories"),
)


def table_contract(relations: Relations) -> DataFrame:
    """Primary keys, unique keys, references and value rules of all operational tables.

    The rules of a few tables are compiled together and run before those of the next, which bounds what lies
    in shuffle files at a time. A parent of several of them is read for each.
    """
    rules: list[Rule] = [Unique(f"pk {table}({key})", table, (key,)) for table, key in PRIMARY_KEYS.items()]
    rules += [Unique(f"unique {table}({', '.join(keys)})", table, tuple(keys)) for table, keys in UNIQUE_KEYS]
    rules += [
        Refers(f"fk {ref.child}({ref.column}) -> {ref.parent}", ref.child, ref.column, ref.parent, PRIMARY_KEYS[ref.parent])
        for ref in REFERENCES
    ]
    rules += [
        Never(f"check {table}: {rule}", table, Q.breaks(rule)) for table, given in VALUE_RULES.items() for rule in given
    ]
    together = [[rule for rule in rules if rule.table in tables] for tables in _RULED_TOGETHER]
    return Q.one_by_one(compiled({table: relations[table] for table in TABLES}, some) for some in together)


def required_values(relations: Relations) -> DataFrame:
    """Missing values in required columns, one pass per table."""
    rules = [
        Never(f"not null {table}.{field.name}", table, F.col(field.name).isNull())
        for table, schema in TABLES.items()
        for field in schema.fields
        if not field.nullable
    ]
    return compiled({table: relations[table] for table in TABLES}, rules)


def require_contract(frame: DataFrame, contract: Contract) -> None:
    """Fail unless columns and types are exactly those of the contract, in any order."""
    have, want = (
        Counter((field.name, field.dataType.simpleString()) for field in schema.fields)
        for schema in (frame.schema, contract.schema)
    )
    if have != want:
        surplus = ", ".join(f"{name} {kind}" for name, kind in sorted((have - want).elements()))
        lacking = ", ".join(f"{name} {kind}" for name, kind in sorted((want - have).elements()))
        raise RuntimeError(f"{contract.name} breaks its contract: lacks ({lacking}), has besides ({surplus})")


def require_output(frame: DataFrame, contract: Contract, rows: int) -> None:
    """Fail unless an output holds at least the contract's columns and some rows."""
    missing = sorted(set(contract.columns) - set(frame.columns))
    if missing:
        raise RuntimeError(f"{contract.name} output is missing columns: {', '.join(missing)}")
    if rows == 0:
        raise RuntimeError(f"{contract.name} output is unexpectedly empty")


def dataset_checks(frame: DataFrame, contract: Contract) -> DataFrame:
    """Not empty, no NULL in the key, no key twice."""
    key = ", ".join(contract.key)
    return Q.all_checks(
        [
            Q.empty_relation(frame, f"{contract.name} is empty"),
            Q.null_keys(frame, contract.key, f"{contract.name} NULL key ({key})"),
            Q.duplicate_keys(frame, contract.key, f"{contract.name} duplicate key ({key})"),
        ]
    )


# --- staging and marts --------------------------------------------------------------------------


def staging_keys(movements: DataFrame, daily: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Duplicated keys and missing key values of the three staged relations."""
    frames = {
        "inventory_movements_processed": movements,
        "inventory_daily_metrics": daily,
        "inventory_snapshot_enriched": snapshot,
    }
    rules: list[Rule] = []
    for name in frames:
        rules.append(Unique(f"duplicate {name}", name, CONTRACTS[name].key, skip_nulls=False))
        rules.append(Never(f"null keys {name}", name, Q.any_null(CONTRACTS[name].key)))
    return compiled(frames, rules)


def mart_checks(stockout: DataFrame, supplier: DataFrame, delivery: DataFrame) -> DataFrame:
    """Grain of the marts and the range of the stock-out rate."""
    suppliers, days = "fct_supplier_performance", "fct_order_delivery_performance_daily"
    return compiled(
        {"stockout": stockout, suppliers: supplier, days: delivery},
        [
            Unique(f"duplicate {suppliers}", suppliers, ("supplier_id",), skip_nulls=False),
            Unique(f"duplicate {days}", days, ("delivery_date",), skip_nulls=False),
            Never(f"null keys {suppliers}", suppliers, F.col("supplier_id").isNull()),
            Never("stockout rate out of range", "stockout", Q.outside("stockout_rate", 0, 1, null_is_violation=True)),
        ],
    )


def reconciliation_check(movements: DataFrame, daily: DataFrame) -> DataFrame:
    """Movement units the daily metrics do not account for."""
    return P.reconciliation(movements, daily).select(
        F.lit("signed minus net quantity").alias("check"), F.col("difference").alias("violations")
    )


def declared_tests(
    movements: DataFrame,
    daily: DataFrame,
    snapshot: DataFrame,
    stockout: DataFrame,
    supplier: DataFrame,
    delivery: DataFrame,
    products: DataFrame,
    warehouses: DataFrame,
) -> DataFrame:
    """The tests declared on staging views and marts: 27 on columns and one on a grain."""
    moves, days, stock = "stg_inventory_movements", "stg_inventory_daily_metrics", "stg_inventory_snapshot"
    rates, suppliers, deliveries = (
        "fct_inventory_stockout_daily", "fct_supplier_performance", "fct_order_delivery_performance_daily",
    )
    required = {
        moves: ("movement_id", "movement_date", "warehouse_id", "product_id", "movement_type"),
        days: ("warehouse_id", "product_id", "movement_date", "movement_count"),
        stock: ("inventory_id", "warehouse_id", "product_id", "snapshot_date", "stock_status"),
        rates: ("snapshot_date", "warehouse_id"),
        suppliers: ("supplier_id", "supplier_name"),
        deliveries: ("delivery_date",),
    }
    ids = {moves: "movement_id", stock: "inventory_id", suppliers: "supplier_id", deliveries: "delivery_date"}
    accepted = {(moves, "movement_type"): MOVEMENT_TYPES, (stock, "stock_status"): STOCK_STATUSES}
    rules: list[Rule] = [
        Never(f"not_null {model}.{name}", model, F.col(name).isNull()) for model, names in required.items() for name in names
    ]
    rules += [
        Never(f"accepted_values {model}.{name}", model, Q.not_accepted(name, values)) for (model, name), values in accepted.items()
    ]
    rules += [Unique(f"unique {model}.{name}", model, (name,)) for model, name in ids.items()]
    rules.append(Unique(f"grain {days}", days, ("warehouse_id", "product_id", "movement_date"), skip_nulls=False))
    rules += [
        Refers(f"relationships {moves}.{column} -> {parent}", moves, column, parent, column)
        for column, parent in (("warehouse_id", "warehouses"), ("product_id", "products"))
    ]
    frames = {
        moves: movements, days: daily, stock: snapshot, rates: stockout, suppliers: supplier, deliveries: delivery,
        "products": products, "warehouses": warehouses,
    }
    return compiled(frames, rules)


# --- analytical gate -------------------------------------------------------------------------------


_PLAIN_NAME = re.compile(r"[A-Za-z0-9_]*[A-Za-z0-9][A-Za-z0-9_]*")


def require_safe_names(names: list[str]) -> None:
    """Relation names may hold letters, digits and underscores only; there must be some."""
    odd = [name for name in names if not _PLAIN_NAME.fullmatch(name)]
    if odd or not names:
        raise RuntimeError(f"Outputs to count must be given by plain names, not {odd or 'none'}")


def analytical_counts(relations: Relations, names: list[str]) -> DataFrame:
    """Row counts of configured outputs; a missing one fails."""
    require_safe_names(names)
    missing = relations.missing(names)
    if missing:
        raise RuntimeError("Outputs to count do not exist: " + ", ".join(missing))
    return P.row_counts({name: relations[name] for name in names}, names)
