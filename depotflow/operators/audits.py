"""Consistency audits between operational tables."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.operators import quality as Q

# --- fixed values -----------------------------------------------------------------------

BASE_RETURN_RATE = 0.07
MAX_RETURN_RATE = 0.15
CATEGORY_RISK = {
    "Footwear": 1.35,
    "Beauty": 1.20,
    "Clothing": 1.30,
    "Cameras": 1.15,
    "Audio": 1.15,
    "Furniture": 0.85,
    "Beverages": 0.70,
    "Grocery": 0.65,
}
SEGMENT_RISK = {"VIP": 1.15, "Premium": 1.08, "Regular": 1.00}

SHIPPED_STATUSES = ("SHIPPED", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "LOST")

GOOD_RATING = Decimal("4.2")
AVERAGE_RATING = Decimal("3.2")

COST_BASE = Decimal("1.06")
COST_PER_RATING_POINT = Decimal("0.01")
COST_TOLERANCE = Decimal("0.02")
MONEY_ROUNDING = Decimal("0.01")
DEFAULT_RATING = Decimal("3")

# --- orders -----------------------------------------------------------------------------


def priced_lines(lines: DataFrame) -> DataFrame:
    """Gross, discount and total of order lines from price, quantity and discount rate."""
    return (
        lines.withColumn("gross_amount", F.col("unit_price") * F.col("quantity"))
        .withColumn("discount", X.money(F.col("gross_amount") * F.col("discount_rate")))
        .withColumn("total_amount", X.money(F.col("gross_amount") - F.col("discount")))
    )


def order_totals(order_items: DataFrame) -> DataFrame:
    """Value of an order as the sum of its lines."""
    return order_items.groupBy("order_id").agg(
        X.money(F.sum("total_amount")).cast("decimal(14,2)").alias("items_total")
    )


def order_value_deviations(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders whose stored value is not the sum of their lines; an order without lines is worth zero."""
    total = F.coalesce("items_total", F.lit(0).cast("decimal(14,2)"))
    return (
        orders.select("order_id", "order_value")
        .join(order_totals(order_items), "order_id", "left")
        .withColumn("items_total", total)
        .filter(~F.col("order_value").eqNullSafe(F.col("items_total")))
    )


# --- returns ----------------------------------------------------------------------------


def expected_refund(total: Column, purchased: Column, returned: Column) -> Column:
    """The share of a line's total that falls on the returned units."""
    return X.money(total * returned / F.nullif(purchased, F.lit(0))).cast("decimal(14,2)")


def refund_deviations(returns: DataFrame, order_items: DataFrame) -> DataFrame:
    """Returns whose refund is not the returned share of the line total, or that have no line."""
    lines = order_items.select("order_item_id", "quantity", "total_amount")
    expected = expected_refund(F.col("total_amount"), F.col("quantity"), F.col("return_quantity"))
    return (
        returns.select("return_id", "order_item_id", "return_quantity", "refund_amount")
        .join(lines, "order_item_id", "left")
        .withColumn("expected_refund", expected)
        .filter(~F.col("refund_amount").eqNullSafe(F.col("expected_refund")))
        .select("return_id", "order_item_id", "return_quantity", "refund_amount", "expected_refund")
    )


def returnable(
    orders: DataFrame, customers: DataFrame, order_items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Lines of delivered orders, whatever their columns, with customer segment and category."""
    delivered = orders.filter(
        (F.col("order_status") == "DELIVERED") & F.col("actual_delivery_date").isNotNull()
    ).select("order_id", "customer_id", "order_date", "actual_delivery_date")
    labelled = products.select("product_id", "category_id").join(
        categories.select("category_id", "category_name"), "category_id"
    )
    return (
        delivered.join(customers.select("customer_id", "customer_segment"), "customer_id")
        .join(order_items, "order_id")
        .join(labelled, "product_id")
    )


def returnable_items(
    orders: DataFrame, customers: DataFrame, order_items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Items of delivered orders, with their customer's segment and their category."""
    return returnable(orders, customers, order_items, products, categories).select(
        "order_id",
        "order_date",
        "actual_delivery_date",
        "customer_segment",
        "order_item_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount",
        "total_amount",
        "category_name",
    )


def return_risk(returnable: DataFrame) -> DataFrame:
    """Chance that an order is returned, from its riskiest category and its customer segment."""
    highest = F.col("max_category_risk")
    segment = X.looked_up(F.col("customer_segment"), SEGMENT_RISK, 1.0)
    probability = F.lit(BASE_RETURN_RATE) * (F.lit(0.75) + highest * F.lit(0.25)) * segment
    return (
        returnable.groupBy("order_id", "customer_segment")
        .agg(F.max(X.looked_up(F.col("category_name"), CATEGORY_RISK, 1.0)).alias("max_category_risk"))
        .withColumn("return_probability", X.clamped(probability, high=MAX_RETURN_RATE))
    )


# --- stock ------------------------------------------------------------------------------


def stock_balance_deviations(inventory: DataFrame) -> DataFrame:
    """Positions whose closing stock does not follow from the day's flows."""
    expected = X.balanced_stock(
        F.col("opening_stock"),
        F.col("received_quantity"),
        F.col("sold_quantity"),
        F.col("returned_quantity"),
        F.col("adjustment_quantity"),
    )
    return (
        inventory.withColumn("expected_closing", expected)
        .filter(F.col("closing_stock") != F.col("expected_closing"))
        .select(
            "inventory_id", "warehouse_id", "product_id", "snapshot_date", "closing_stock", "expected_closing"
        )
    )


_WORD_BITS = 64


def _word(warehouse: str) -> Column:
    """Which word of a bitmap a warehouse number falls in; its place there is the rest."""
    return F.shiftright(F.col(warehouse), 6)


def _bit(warehouse: str) -> Column:
    return F.expr(f"shiftleft(1L, CAST(pmod({warehouse}, {_WORD_BITS}) AS INT))")


def missing_positions(
    warehouses: DataFrame, products: DataFrame, inventory: DataFrame, snapshot_date: Column
) -> DataFrame:
    """Warehouse and active product pairs without a stock position on a date.

    The warehouses that stock a product are bitmaps, words of 64 warehouse numbers merged by OR, and only
    words with a bit set are carried. The words of all warehouses are one small value, 16 bytes for
    64 warehouses, from which each product's are taken away in place; a product that is
    stocked everywhere has no bits left and is dropped. Only the missing pairs are ever made.
    """
    every = (
        warehouses.filter("warehouse_id IS NOT NULL")
        .groupBy(_word("warehouse_id").alias("word"))
        .agg(F.bit_or(_bit("warehouse_id")).alias("bits"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))))
        .scalar()
    )
    held = (
        inventory.filter((F.col("snapshot_date") == snapshot_date) & F.col("warehouse_id").isNotNull())
        .groupBy("product_id", _word("warehouse_id").alias("word"))
        .agg(F.bit_or(_bit("warehouse_id")).alias("bits"))
        .groupBy("product_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    )
    none = F.lit(0).cast("bigint")

    def left(entry: Column) -> Column:
        stocked = F.coalesce(F.try_element_at("held", entry["word"]), none)
        return F.struct(entry["word"].alias("word"), entry["bits"].bitwiseAND(F.bitwise_not(stocked)).alias("bits"))

    open_words = F.filter(F.transform("every", left), lambda entry: F.bit_count(entry["bits"]) > 0)
    set_bits = F.expr(f"filter(sequence(0, {_WORD_BITS - 1}), b -> shiftright(open.bits, b) & 1L = 1L)")
    return (
        products.filter("is_active")
        .select("product_id")
        .join(held, "product_id", "left")
        .withColumn("every", every)
        .select("product_id", F.explode(open_words).alias("open"))
        .select("product_id", F.col("open.word").alias("word"), F.explode(set_bits).alias("place"))
        .select((F.col("word") * _WORD_BITS + F.col("place")).alias("warehouse_id"), "product_id")
    )


# --- shipments and purchasing -------------------------------------------------------------


def shipment_consistency(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Violations of the rules that tie a shipment's state to its order's."""
    order_status, status = F.col("order_status"), F.col("shipment_status")
    shipped, delivered = F.col("shipped_at"), F.col("actual_delivery_date")
    paired = shipments.select("order_id", "shipment_status", "shipped_at", "actual_delivery_date").join(
        orders.select("order_id", "order_status"), "order_id"
    )
    return Q.row_rules(
        paired,
        {
            "cancelled order with another shipment status": (order_status == "CANCELLED")
            & (status != "CANCELLED"),
            "delivered order with another shipment status": order_status.isin("DELIVERED", "RETURNED")
            & (status != "DELIVERED"),
            "shipping date missing": status.isin(*SHIPPED_STATUSES) & shipped.isNull(),
            "shipping date too early": ~status.isin(*SHIPPED_STATUSES) & shipped.isNotNull(),
            "delivery date missing": (status == "DELIVERED") & delivered.isNull(),
            "delivery date without delivery": (status != "DELIVERED") & delivered.isNotNull(),
            "delivered before shipped": delivered < shipped,
        },
    )


def purchase_order_consistency(purchase_orders: DataFrame, purchase_order_items: DataFrame) -> DataFrame:
    """Violations of the rules that tie received units and dates to a purchase order's status."""
    status, ordered, received = F.col("po_status"), F.col("ordered_quantity"), F.col("received_quantity")
    arrived = F.col("actual_delivery_date")
    lines = purchase_order_items.select("po_id", "ordered_quantity", "received_quantity").join(
        purchase_orders.select("po_id", "po_status"), "po_id"
    )
    on_lines = Q.row_rules(
        lines,
        {
            "received order not received in full": (status == "RECEIVED") & (received != ordered),
            "partial receipt out of range": (status == "PARTIALLY_RECEIVED")
            & ((received < 1) | (received >= ordered)),
            "units received on another status": ~status.isin("RECEIVED", "PARTIALLY_RECEIVED")
            & (received != 0),
        },
    )
    on_orders = Q.row_rules(
        purchase_orders,
        {
            "delivery date missing": status.isin("RECEIVED", "PARTIALLY_RECEIVED") & arrived.isNull(),
            "delivery date without receipt": ~status.isin("RECEIVED", "PARTIALLY_RECEIVED")
            & arrived.isNotNull(),
        },
    )
    return Q.all_checks([on_lines, on_orders])


def receipt_deviations(purchase_orders: DataFrame, purchase_order_items: DataFrame) -> DataFrame:
    """Lines of fully received orders that did not receive what was ordered."""
    complete = purchase_orders.filter(F.col("po_status") == "RECEIVED").select("po_id")
    return (
        purchase_order_items.filter(F.col("received_quantity") != F.col("ordered_quantity"))
        .join(complete, "po_id", "left_semi")
        .select("po_item_id", "po_id", "product_id", "ordered_quantity", "received_quantity")
    )


def cost_band_deviations(
    purchase_order_items: DataFrame, purchase_orders: DataFrame, products: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Purchase lines whose unit cost lies outside the band around the product cost.

    Lines whose order, product or supplier is unknown have no band and are reported too.
    """
    rating = F.coalesce(F.nullif(F.col("rating"), F.lit(0).cast("decimal(3,2)")), F.lit(DEFAULT_RATING))
    sources = purchase_orders.select("po_id", "supplier_id").join(
        suppliers.select(
            "supplier_id",
            (F.lit(COST_BASE) - rating * F.lit(COST_PER_RATING_POINT)).cast("decimal(6,4)").alias("cost_factor"),
        ),
        "supplier_id",
        "left",
    )
    costs = products.select("product_id", F.col("unit_cost").alias("product_cost"))
    distance = F.abs(F.col("unit_cost") - F.col("product_cost") * F.col("cost_factor"))
    return (
        purchase_order_items.select("po_item_id", "po_id", "product_id", "unit_cost")
        .join(sources, "po_id", "left")
        .join(costs, "product_id", "left")
        .filter(F.coalesce(distance > F.col("product_cost") * F.lit(COST_TOLERANCE) + F.lit(MONEY_ROUNDING), F.lit(True)))
        .select("po_item_id", "po_id", "product_id", "supplier_id", "unit_cost", "product_cost", "cost_factor")
    )


# --- suppliers ----------------------------------------------------------------------------


def supplier_tier(rating: Column) -> Column:
    return (
        F.when(rating >= F.lit(GOOD_RATING), F.lit("GOOD"))
        .when(rating >= F.lit(AVERAGE_RATING), F.lit("AVERAGE"))
        .otherwise(F.lit("PROBLEM"))
    )


def supplier_tiers(suppliers: DataFrame) -> DataFrame:
    """Suppliers per tier."""
    return suppliers.groupBy(supplier_tier(F.col("rating")).alias("tier")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )


def supplier_assortment(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Active products each active supplier can be asked for; without own ones, all of them."""
    active = products.filter("is_active")
    own = active.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("own_products"))
    everything = active.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        suppliers.filter("is_active")
        .select("supplier_id")
        .join(own, "supplier_id", "left")
        .select(
            "supplier_id",
            F.coalesce("own_products", F.lit(0).cast("bigint")).alias("own_products"),
            F.coalesce(F.col("own_products"), everything).alias("selectable_products"),
            F.col("own_products").isNull().alias("falls_back"),
        )
    )


# --- loading ------------------------------------------------------------------------------


def first_by_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the lowest by the order columns, so reruns keep the same row."""
    rest = [name for name in frame.columns if name not in keys]
    ranked = [name for name in order if name in rest] + [name for name in rest if name not in order]
    kept = frame.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("kept"))
    return kept.select(*[F.col(name) if name in keys else F.col(f"kept.{name}") for name in frame.columns])


def absent_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Incoming rows whose key the target does not hold yet, one per key."""
    return first_by_key(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti").select(
        *incoming.columns
    )


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The target after adding what it lacks; rows it already holds stay as they are."""
    return existing.unionByName(absent_rows(existing, incoming, keys, order))
