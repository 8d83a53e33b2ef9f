"""Operators on small hand-made tables."""

from __future__ import annotations

import threading
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from depotflow.model import DAILY_METRICS, MOVEMENTS_PROCESSED, SNAPSHOT_ENRICHED, TABLES
from depotflow.operators import audits as R
from depotflow.operators import inventory as I
from depotflow.operators import ledger as L
from depotflow.operators import marts as M
from depotflow.operators import movement_audit as A
from depotflow.operators import profiles as P
from depotflow.operators import quality as Q
from depotflow.operators import standardize as S
from depotflow.operators.rules import HasRows, Never, Refers, Unique, compiled
from depotflow.plans import checks, commits, loads
from depotflow.session import scratch_path
from depotflow.sources.files import write_dataset

NOON = datetime(2024, 5, 6, 12)


def table(spark, name, *records):
    """A table with the named columns set and all others NULL."""
    schema = TABLES[name]
    loose = [f"{field.name} {field.dataType.simpleString()}" for field in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in records], ", ".join(loose))


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "products": table(
            spark, "products",
            dict(product_id=1, sku="A", product_name="a", category_id=1, reorder_point=5),
            dict(product_id=2, sku="B", product_name="b", category_id=9, reorder_point=5),
        ),
        "warehouses": table(spark, "warehouses", dict(warehouse_id=1, warehouse_name="w", city="c", state="s")),
        "categories": table(spark, "categories", dict(category_id=1, category_name="k")),
    }


def movement(movement_id, warehouse=1, product=1, kind="SALE", quantity=2, at=NOON, reference=None):
    return dict(
        movement_id=movement_id, warehouse_id=warehouse, product_id=product, movement_type=kind,
        quantity=quantity, movement_date=at, reference_id=reference,
    )


@pytest.fixture(scope="module")
def moves(spark):
    return table(
        spark, "inventory_movements",
        movement(1), movement(2, kind="RETURN", quantity=3), movement(3, kind="ADJUSTMENT", quantity=7),
        movement(4, product=77), movement(5, warehouse=None), movement(6, product=2),
    )


def test_enriched_movements_keep_orphans_and_match_the_contract(moves, dims):
    enriched = I.enriched_movements(moves, **dims)
    checks.require_contract(enriched, MOVEMENTS_PROCESSED)
    got = {row["movement_id"]: row for row in enriched.collect()}
    assert len(got) == 6
    assert got[4]["sku"] is None and got[5]["warehouse_name"] is None and got[6]["category_name"] is None
    assert [got[i]["signed_quantity"] for i in (1, 2, 3)] == [-2, 3, 0]
    assert got[1]["movement_date"] == date(2024, 5, 6) and got[1]["movement_week"] == 19


def test_daily_metrics_agree_with_the_early_aggregation(moves, dims):
    late = I.daily_metrics(I.enriched_movements(moves, **dims))
    early = I.daily_metrics_from_sources(moves, **dims)
    checks.require_contract(late, DAILY_METRICS)
    checks.require_contract(early, DAILY_METRICS)
    assert rows(late) == rows(early)
    mine = late.filter("product_id = 1 AND warehouse_id = 1").first()
    assert (mine["inbound_quantity"], mine["outbound_quantity"], mine["net_quantity"], mine["movement_count"]) == (3, 2, 1, 3)
    assert P.reconciliation(I.enriched_movements(moves, **dims), late).first()[0] == 0


def test_daily_metrics_agree_even_with_a_duplicated_dimension_row(moves, dims):
    twice = dims | {"products": dims["products"].unionByName(dims["products"])}
    assert rows(I.daily_metrics(I.enriched_movements(moves, **twice))) == rows(
        I.daily_metrics_from_sources(moves, **twice)
    )


def test_snapshot_and_stockout_rate(spark, dims):
    day = date(2024, 5, 31)
    stock = table(
        spark, "inventory",
        *[
            dict(inventory_id=i, warehouse_id=1, product_id=1, snapshot_date=day, closing_stock=c, reserved_quantity=r)
            for i, (c, r) in enumerate([(5, 5), (9, 4), (20, 1)])
        ],
    )
    snapshot = I.enriched_snapshot(stock, **dims)
    checks.require_contract(snapshot, SNAPSHOT_ENRICHED)
    assert [row["stock_status"] for row in snapshot.orderBy("inventory_id").collect()] == ["STOCK_OUT", "REORDER", "HEALTHY"]
    mart = M.stockout_daily(snapshot).first()
    assert (mart["inventory_positions"], mart["stockout_positions"], mart["stockout_rate"], mart["available_units"]) == (3, 1, 0.3333, 24)


def test_supplier_without_orders(spark):
    suppliers = table(spark, "suppliers", dict(supplier_id=1, supplier_name="x"), dict(supplier_id=2, supplier_name="y"))
    orders = table(
        spark, "purchase_orders",
        dict(po_id=1, supplier_id=1, expected_delivery_date=NOON, actual_delivery_date=NOON),
        dict(po_id=2, supplier_id=1, expected_delivery_date=NOON, actual_delivery_date=datetime(2024, 5, 6, 12, 0, 1)),
        dict(po_id=3, supplier_id=1, expected_delivery_date=NOON),
    )
    items = table(
        spark, "purchase_order_items",
        dict(po_item_id=1, po_id=1, ordered_quantity=10, received_quantity=10),
        dict(po_item_id=2, po_id=1, ordered_quantity=10, received_quantity=5),
    )
    assert rows(M.supplier_performance(suppliers, orders, items)) == [
        (1, "x", 3, 2, 1, 0.5, 20, 15, 0.75),
        (2, "y", 0, 0, 0, None, 0, 0, None),
    ]


def test_delivery_day_without_promises(spark):
    orders = table(
        spark, "orders",
        dict(order_id=1, order_date=datetime(2024, 5, 1), actual_delivery_date=NOON, order_status="RETURNED"),
        dict(order_id=2, order_date=datetime(2024, 5, 1)),
    )
    assert rows(M.delivery_performance_daily(orders)) == [(date(2024, 5, 6), 1, 0, 0, None, 5.5)]


def test_reference_checks(spark):
    lines = table(
        spark, "purchase_order_items",
        dict(po_item_id=10, po_id=1, product_id=1, received_quantity=4),
        dict(po_item_id=11, po_id=2, product_id=1, received_quantity=4),
        dict(po_item_id=-5, po_id=1, product_id=1, received_quantity=4),
    )
    heads = table(spark, "purchase_orders", dict(po_id=1, warehouse_id=1))

    def invalid(reference, **changes):
        row = movement(1, kind="PURCHASE_RECEIPT", quantity=4, reference=reference) | changes
        frame = table(spark, "inventory_movements", row)
        return A.purchase_reference_check(frame, lines, heads).first()["violations"]

    assert invalid("PO-1-10") == 0
    bad = [None, "PO-1-10\n", "XPO-1-10", "PO-1", "PO-2-10", "PO-1-99", "PO-2-11", "PO-1-99999999999999999999",
           "PO-99999999999999999999-10"]
    assert [invalid(reference) for reference in bad] == [1] * len(bad)
    assert invalid("PO-1-10", quantity=5) == 1
    assert invalid("PO-1-10", warehouse_id=2) == 1
    assert invalid("PO-1-10", product_id=2) == 1
    assert invalid("PO-1-10", warehouse_id=None) == 0
    assert invalid("nonsense", movement_type="SALE") == 0


def test_transfers_and_adjustments(spark):
    frame = table(
        spark, "inventory_movements",
        movement(1, 1, kind="TRANSFER_OUT", reference="T1"), movement(2, 2, kind="TRANSFER_IN", reference="T1"),
        movement(3, 1, kind="TRANSFER_OUT", reference="T2"), movement(4, 1, kind="TRANSFER_IN", reference="T2"),
        movement(5, 1, kind="TRANSFER_OUT", reference="T3"),
        movement(6, 1, kind="TRANSFER_OUT", reference="T4"), movement(7, 2, kind="TRANSFER_IN", quantity=9, reference="T4"),
        movement(8, kind="ADJUSTMENT", reference="ADJ-IN-1"), movement(9, kind="ADJUSTMENT", reference="ADJ-UP-1"),
        movement(10, kind="ADJUSTMENT", reference=None),
    )
    assert [row["reference_id"] for row in A.unpaired_transfers(frame).orderBy("reference_id").collect()] == ["T2", "T3", "T4"]
    assert A.transfer_check(frame).first()["violations"] == 3
    assert A.adjustment_check(frame).first()["violations"] == 1


def test_missing_references_and_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(2,)], "k bigint")
    strict = Q.missing_references(child, "k", parent, "k", "c", null_is_violation=True)
    lenient = Q.missing_references(child, "k", parent, "k", "c", null_is_violation=False)
    assert (strict.first()["violations"], lenient.first()["violations"]) == (3, 2)
    two = child.selectExpr("k", "cast(2 as bigint) AS j")
    wanted = {"k": ("k", parent, "k"), "j": ("j", parent, "k")}
    for frame, nulls, expected in ((two, True, (0, 3)), (two, False, (0, 2)), (two.filter("false"), True, (0, 0))):
        assert rows(Q.missing_references_of(frame, wanted, nulls)) == [("j", expected[0]), ("k", expected[1])]


def test_generic_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (None, None)], "k bigint, v string")
    found = dict(
        rows(
            Q.all_checks(
                [
                    Q.row_rules(frame, {"accepted": Q.not_accepted("v", ["a", "b"]), "rule": Q.breaks("k > 1")}),
                    Q.null_keys(frame, ["k", "v"], "nulls"),
                    Q.duplicate_keys(frame, ["k"], "twice"),
                    Q.duplicate_keys(frame, ["k"], "twice set", ignore_nulls=True),
                    Q.empty_relation(frame, "empty"),
                    Q.empty_relation(frame.filter("false"), "none"),
                ]
            )
        )
    )
    assert found == {"accepted": 1, "rule": 2, "nulls": 2, "twice": 2, "twice set": 1, "empty": 0, "none": 1}
    with pytest.raises(Q.QualityError, match="t: nulls: 2; twice: 2"):
        Q.require_clean(
            Q.all_checks([Q.duplicate_keys(frame, ["k"], "twice"), Q.null_keys(frame, ["k", "v"], "nulls")]), "t"
        )
    first = Q.empty_relation(frame.filter("false"), "none")
    with pytest.raises(Q.QualityError, match="one"):
        Q.require_each([("one", first), ("two", first)])
    with pytest.raises(RuntimeError, match="inventory is missing columns: closing_stock"):
        S.require_columns({"inventory": table(spark, "inventory").drop("closing_stock")}, {"inventory": ["closing_stock"]})


def test_contract_mismatch(moves, dims):
    enriched = I.enriched_movements(moves, **dims)
    checks.require_contract(enriched.select(*reversed(enriched.columns)), MOVEMENTS_PROCESSED)
    with pytest.raises(RuntimeError, match=r"lacks \(sku string\), has besides \(other string\)"):
        checks.require_contract(enriched.withColumnRenamed("sku", "other"), MOVEMENTS_PROCESSED)
    with pytest.raises(RuntimeError, match=r"lacks \(quantity int\), has besides \(quantity bigint\)"):
        checks.require_contract(enriched.withColumn("quantity", F.col("quantity").cast("bigint")), MOVEMENTS_PROCESSED)
    with pytest.raises(RuntimeError, match="unexpectedly empty"):
        checks.require_output(enriched, MOVEMENTS_PROCESSED, 0)


def test_ledger(spark):
    lines = table(
        spark, "purchase_order_items",
        dict(po_item_id=1, po_id=5, product_id=1, received_quantity=3), dict(po_item_id=2, po_id=5, product_id=1, received_quantity=0),
    )
    pos = table(spark, "purchase_orders", dict(po_id=5, warehouse_id=8, expected_delivery_date=NOON))
    items = table(
        spark, "order_items",
        dict(order_item_id=1, order_id=1, product_id=2, quantity=4), dict(order_item_id=2, order_id=2, product_id=2, quantity=4),
        dict(order_item_id=3, order_id=3, product_id=2, quantity=4),
    )
    orders = table(
        spark, "orders",
        dict(order_id=1, warehouse_id=7, order_date=NOON, order_status="SHIPPED"),
        dict(order_id=2, warehouse_id=7, order_date=NOON, order_status="CANCELLED"),
        dict(order_id=3, order_date=NOON, order_status="SHIPPED"),
    )
    back = table(
        spark, "returns",
        dict(return_id=9, order_id=1, product_id=2, return_quantity=1, return_date=NOON),
        dict(return_id=8, order_id=3, product_id=2, return_quantity=1, return_date=NOON),
    )
    assert rows(L.movement_ledger(lines, pos, items, orders, back)) == [
        (1 * 10**15 + 1, 8, 1, "PURCHASE_RECEIPT", 3, NOON, "PO-5-1"),
        (2 * 10**15 + 1, 7, 2, "SALE", 4, NOON, "ORD-1-1"),
        (3 * 10**15 + 9, 7, 2, "RETURN", 1, NOON, "RET-9"),
    ]


def test_order_audits(spark):
    items = table(spark, "order_items", dict(order_item_id=1, order_id=1, quantity=6, total_amount=Decimal("0.05")))
    orders = table(spark, "orders", dict(order_id=1, order_value=Decimal("0.06")), dict(order_id=2, order_value=Decimal("1.00")))
    assert rows(R.order_value_deviations(orders, items)) == [
        (1, Decimal("0.06"), Decimal("0.05")), (2, Decimal("1.00"), Decimal("0.00"))
    ]
    back = table(
        spark, "returns",
        dict(return_id=1, order_item_id=1, return_quantity=3, refund_amount=Decimal("0.03")),
        dict(return_id=2, order_item_id=1, return_quantity=3, refund_amount=Decimal("0.02")),
        dict(return_id=3, order_item_id=5, return_quantity=1, refund_amount=Decimal("0.02")),
    )
    assert rows(R.refund_deviations(back, items)) == [
        (2, 1, 3, Decimal("0.02"), Decimal("0.03")), (3, 5, 1, Decimal("0.02"), None)
    ]
    lines = spark.createDataFrame(
        [(1, Decimal("10.05"), 3, Decimal("0.15"))], "order_id bigint, unit_price decimal(12,2), quantity int, discount_rate decimal(4,2)"
    )
    priced = R.priced_lines(lines).first()
    assert (priced["gross_amount"], priced["discount"], priced["total_amount"]) == (Decimal("30.15"), Decimal("4.52"), Decimal("25.63"))


def test_return_risk(spark):
    items = spark.createDataFrame(
        [(1, "VIP", "Footwear"), (1, "VIP", "Beverages"), (2, "Regular", "Books"), (3, "VIP", "Mens Clothing")],
        "order_id bigint, customer_segment string, category_name string",
    )
    got = {row[0]: (row[2], row[3]) for row in R.return_risk(items).collect()}
    assert got[1] == (1.35, pytest.approx(0.07 * (0.75 + 1.35 * 0.25) * 1.15))
    assert got[2] == (1.0, pytest.approx(0.07))
    assert got[3][0] == 1.0


def test_missing_positions_match_brute_force(spark):
    sites = table(spark, "warehouses", *[dict(warehouse_id=i) for i in range(40)])
    goods = table(spark, "products", *[dict(product_id=i, is_active=i % 4 != 0) for i in range(30)])
    day, other = date(2024, 1, 31), date(2023, 12, 31)
    held = [(w, p) for w in range(40) for p in range(30) if (w * 7 + p) % 5]
    stock = table(
        spark, "inventory",
        *[dict(warehouse_id=w, product_id=p, snapshot_date=day) for w, p in held],
        dict(warehouse_id=0, product_id=5, snapshot_date=other),
    )
    wanted = {(w, p) for w in range(40) for p in range(30) if p % 4} - set(held)
    missing = R.missing_positions(sites, goods, stock, F.lit(day))
    got = rows(missing)
    assert len(got) == len(set(got)) and set(got) == wanted
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_missing_positions_of_many_and_odd_warehouse_numbers(spark):
    ids = [-65, -64, -1, 0, 1, 63, 64, 127, 128, 5_000, 2**40, 2**62]
    sites = table(spark, "warehouses", *[dict(warehouse_id=i) for i in ids], dict(warehouse_id=None))
    goods = table(spark, "products", *[dict(product_id=i, is_active=True) for i in (1, 2, 3)])
    day = date(2024, 1, 31)
    held = [(w, 1) for w in ids] + [(w, 2) for w in ids[::2]] + [(77, 2), (None, 2)]
    stock = table(spark, "inventory", *[dict(warehouse_id=w, product_id=p, snapshot_date=day) for w, p in held])
    got = rows(R.missing_positions(sites, goods, stock, F.lit(day)))
    assert sorted(got) == sorted([(w, 2) for w in ids[1::2]] + [(w, 3) for w in ids])
    assert R.missing_positions(sites.limit(0), goods, stock, F.lit(day)).collect() == []


def test_rules_agree_with_single_checks(spark):
    left = spark.createDataFrame(
        [(1, "a", 1, date(2024, 1, 1)), (1, "b", 2, None), (2, None, 9, date(2024, 1, 1)), (None, "c", None, None),
         (None, "c", 9, None), (3, "a", 9, None)],
        "id bigint, name string, ref int, day date",
    )
    right = spark.createDataFrame([(1,), (2,), (2,), (None,)], "key bigint")
    none = left.limit(0)
    rules = [
        Unique("id", "left", ("id",)), Unique("id with nulls", "left", ("id",), skip_nulls=False), Unique("name", "left", ("name",)),
        Unique("pair", "left", ("id", "day"), skip_nulls=False), Unique("mixed", "left", ("id", "name"), skip_nulls=False),
        Unique("key", "right", ("key",)), Refers("ref", "left", "ref", "right", "key"),
        Refers("ref or null", "left", "ref", "right", "key", null_is_violation=True), Never("low", "left", F.col("ref") < 2),
        Never("null name", "left", F.col("name").isNull()), HasRows("left has rows", "left"), HasRows("none has rows", "none"),
        Never("never", "none", F.lit(True)), Refers("back", "right", "key", "left", "id"),
    ]
    result = compiled({"left": left, "right": right, "none": none}, rules)
    assert {r[0]: r[1] for r in result.collect()} == {
        "id": 1, "id with nulls": 2, "name": 2, "pair": 1, "mixed": 1, "key": 1, "ref": 3, "ref or null": 4, "low": 1,
        "null name": 1, "left has rows": 0, "none has rows": 1, "never": 0, "back": 0,
    }
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 4  # each table once, and the list of rules


def test_a_load_is_done_once(spark):
    root = scratch_path(spark, "test-load")
    schema = "k bigint, v string"
    first = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x")], schema)
    assert loads.load_absent(spark, root, "one", first, ["k"], ["v"]) == 2
    assert loads.load_absent(spark, root, "one", first, ["k"], ["v"]) == 0  # skipped: it is in the log
    write_dataset(first, f"{root}/loads/killed")  # a load that died before its commit: nobody reads it
    second = spark.createDataFrame([(2, "y"), (3, "z")], schema)
    assert loads.load_absent(spark, root, "two", second, ["k"]) == 1
    assert loads.load_absent(spark, root, "three", second, ["k"]) == 0
    assert rows(loads.loaded(spark, root, first.schema)) == [(1, "a"), (2, "x"), (3, "z")]
    assert [c.run for c in commits.history(spark, root)] == ["one", "two", "three"]


def test_loads_at_the_same_time_add_no_key_twice(spark):
    root = scratch_path(spark, "test-loads")
    frame = spark.createDataFrame([(i, "x") for i in range(50)], "k bigint, v string")
    added = []
    threads = [threading.Thread(target=lambda i=i: added.append(loads.load_absent(spark, root, f"l{i}", frame, ["k"]))) for i in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(added) == [0, 0, 50] and loads.loaded(spark, root, frame.schema).count() == 50


def test_purchase_consistency_and_costs(spark):
    pos = table(
        spark, "purchase_orders",
        dict(po_id=1, supplier_id=1, po_status="RECEIVED"),
        dict(po_id=2, supplier_id=2, po_status="PARTIALLY_RECEIVED", actual_delivery_date=NOON),
        dict(po_id=3, supplier_id=1, po_status="CANCELLED", actual_delivery_date=NOON),
    )
    lines = table(
        spark, "purchase_order_items",
        dict(po_item_id=1, po_id=1, product_id=1, ordered_quantity=5, received_quantity=4, unit_cost=Decimal("103.00")),
        dict(po_item_id=2, po_id=2, product_id=1, ordered_quantity=5, received_quantity=5, unit_cost=Decimal("105.01")),
        dict(po_item_id=3, po_id=3, product_id=1, ordered_quantity=5, received_quantity=1, unit_cost=Decimal("105.02")),
    )
    assert {label: n for label, n in rows(R.purchase_order_consistency(pos, lines))} == {
        "received order not received in full": 1,
        "partial receipt out of range": 1,
        "units received on another status": 1,
        "delivery date missing": 1,
        "delivery date without receipt": 1,
    }
    assert rows(R.receipt_deviations(pos, lines)) == [(1, 1, 1, 5, 4)]
    goods = table(spark, "products", dict(product_id=1, unit_cost=Decimal("100.00")))
    sources = table(spark, "suppliers", dict(supplier_id=1, rating=Decimal("0.00")), dict(supplier_id=2))
    # Without a rating the band is 1.03 +- 0.02, and a cent of rounding is allowed.
    assert [row[0] for row in rows(R.cost_band_deviations(lines, pos, goods, sources))] == [3]


def test_suppliers(spark):
    rated = [Decimal("4.20"), Decimal("4.19"), Decimal("3.20"), Decimal("3.19"), None]
    suppliers = table(spark, "suppliers", *[dict(supplier_id=i, rating=r, is_active=True) for i, r in enumerate(rated)])
    assert rows(R.supplier_tiers(suppliers)) == [("AVERAGE", 2), ("GOOD", 1), ("PROBLEM", 2)]
    goods = table(
        spark, "products",
        dict(product_id=1, supplier_id=0, is_active=True), dict(product_id=2, supplier_id=0, is_active=True),
        dict(product_id=3, supplier_id=1, is_active=False),
    )
    got = rows(R.supplier_assortment(suppliers.filter("supplier_id < 2"), goods))
    assert got == [(0, 2, 2, False), (1, 0, 2, True)]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(R.insert_if_absent(existing, incoming, ["k"], ["v"])) == [(1, "old"), (2, "a")]


def test_faulty_rows_and_profiles(spark, moves):
    as_of = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    faults = {row[0]: row[-1] for row in checks.faulty_movements(moves, as_of).collect()}
    assert faults[1] == "future movement timestamps"
    assert faults[5] == "movements with NULL required fields; future movement timestamps"
    assert rows(P.movement_type_histogram(moves)) == [("ADJUSTMENT", 1), ("RETURN", 1), ("SALE", 4)]
    exact = P.table_profile(moves, "total", {"products": "product_id"}).first()
    near = P.table_profile(moves, "total", {"products": "product_id"}, approximate=True).first()
    assert tuple(exact) == (6, 3) == tuple(near)
    assert checks.require_safe_names(["ok_1"]) is None
    for bad in ([], ["a;b"]):
        with pytest.raises(RuntimeError):
            checks.require_safe_names(bad)
