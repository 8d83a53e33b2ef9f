"""The operational tables, derived from TPC-H-like tables.

The operators work on a supply-chain model. Where only TPC-H-like Parquet tables are at
hand, these views map them onto it row by row. Small deviations are built in on purpose, so
that the audits have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.model import LEDGER_BRANCH, PRIMARY_KEYS, REFERENCES, RETURN_REASONS, TABLES, VALUE_RULES
from depotflow.sources.relations import Relations

# --- fixed values -----------------------------------------------------------------------

SNAPSHOT_DATES = ("2001-11-30", "2001-12-31")
CATEGORY_OF_TYPE = {
    "ECONOMY": (1, "Footwear"),
    "LARGE": (2, "Beauty"),
    "MEDIUM": (3, "Cameras"),
    "PROMO": (4, "Audio"),
    "SMALL": (5, "Furniture"),
    "STANDARD": (6, "Beverages"),
}
CREATED_AT = "1995-01-01"

# A line's id is its bucket, of 2^24, times the room of a bucket, plus its place there.
_BUCKET_HEX_DIGITS = 6
_BUCKET_ROOM = 59_000_003

_LINE_COLUMNS = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_BUCKET_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# --- order lines --------------------------------------------------------------------------


def numbered_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines with a unique ``line_id`` that depends on nothing but the lines themselves.

    Lines are placed in small, even buckets by a hash of their keys and numbered there in the order
    of all their columns, so equal lines, which nothing tells apart, get numbers in a row. That is one
    shuffle and one sort. Fails if a bucket overflows.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in _BUCKET_KEYS]).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, _BUCKET_HEX_DIGITS), 16, 10).cast("bigint")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("l_orderkey", *_LINE_COLUMNS))
    fits = F.when(F.col("place") <= _BUCKET_ROOM, F.col("place")).otherwise(
        F.raise_error(F.lit("More lines share a bucket than there are ids for")).cast("int")
    )
    return (
        lineitem.select("l_orderkey", *_LINE_COLUMNS)
        .withColumn("bucket", bucket)
        .withColumn("place", place)
        .withColumn("line_id", F.col("bucket") * _BUCKET_ROOM + fits - 1)
        .drop("bucket", "place")
    )


# --- the views ------------------------------------------------------------------------------


def _literal(value: object) -> str:
    """A value as SQL text."""
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def _choice(values: dict[str, object], column: str, other: str) -> str:
    """A CASE over a fixed mapping, with a rule for any other value."""
    arms = " ".join(f"WHEN {_literal(name)} THEN {_literal(value)}" for name, value in values.items())
    return f"CASE {column} {arms} ELSE {other} END"


_CATEGORY_ID = _choice(
    {name: number for name, (number, _) in CATEGORY_OF_TYPE.items()},
    "p_type",
    "1000 + CAST(conv(substr(md5(CAST(p_type AS BINARY)), 1, 10), 16, 10) AS BIGINT)",
)
_CATEGORY_NAME = _choice({name: label for name, (_, label) in CATEGORY_OF_TYPE.items()}, "p_type", "p_type")
_RATING = "CAST((200 + ({key} * 37) % 301) / CAST(100 AS DECIMAL(3,0)) AS DECIMAL(3,2))"
_LEAD_DAYS = "CAST(3 + {key} % 18 AS INT)"
_PRICE = "CAST(p_retailprice AS DECIMAL(12,2))"
_COST = f"CAST(round({_PRICE} * 0.80, 2) AS DECIMAL(12,2))"
_PO_ID = "l_suppkey * 1000 + (year(l_shipdate) - 1995) * 12 + month(l_shipdate)"
_PO_STATUS = (
    "CASE WHEN {key} % 10 = 0 THEN 'CANCELLED' WHEN {key} % 10 IN (1, 2) THEN 'PARTIALLY_RECEIVED'"
    " ELSE 'RECEIVED' END"
)


def _received(ordered: str, line: str) -> str:
    """Units received on a purchase line; the status follows from the order's id."""
    return (
        f"CAST(CASE WHEN po_id % 10 = 0 THEN 0 WHEN po_id % 10 IN (1, 2) THEN ({ordered}) DIV 2"
        f" ELSE ({ordered}) - CASE WHEN {line} % 211 = 0 THEN 1 ELSE 0 END END AS INT)"
    )


def _after(start: str, days: str, hours: str = "0") -> str:
    return f"{start} + make_dt_interval(CAST({days} AS INT), CAST({hours} AS INT))"


class _Views:
    """Builders of the views over one folder of Parquet tables; each is built once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    # dimensions

    def categories(self) -> DataFrame:
        """One row per part type; types outside the fixed mapping keep their own name."""
        known = self.table("part").filter("p_type IS NOT NULL").select("p_type").distinct()
        return known.selectExpr(
            f"CAST({_CATEGORY_ID} AS BIGINT) AS category_id",
            f"{_CATEGORY_NAME} AS category_name",
            f"concat('Dept', ({_CATEGORY_ID}) % 3) AS department",
        )

    def site_count(self) -> Column:
        """The warehouse numbers in use run from zero to one less than this."""
        return self.table("nation").agg((F.max("n_nationkey") + 1).cast("bigint")).scalar()

    def places(self) -> DataFrame:
        regions = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(regions, "n_regionkey", "left").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS place_id", "n_name AS place_name", "r_name AS place_state"
        )

    def warehouses(self) -> DataFrame:
        return self.view("places").selectExpr(
            "place_id AS warehouse_id",
            "place_name AS warehouse_name",
            "place_name AS city",
            "place_state AS state",
            "'Earth' AS country",
            "CAST(NULL AS STRING) AS warehouse_type",
            "100000 + 1000 * place_id AS capacity_units",
            "CAST(40000 + 100 * place_id AS DECIMAL(12,2)) AS operating_cost_per_day",
            "CAST(NULL AS DECIMAL(9,6)) AS latitude",
            "CAST(NULL AS DECIMAL(9,6)) AS longitude",
            "CAST(NULL AS DATE) AS opened_at",
        )

    def suppliers(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS supplier_id",
            "s_name AS supplier_name",
            "'Earth' AS country",
            "CAST(NULL AS STRING) AS state",
            "CAST(NULL AS STRING) AS city",
            "CAST(NULL AS STRING) AS supplier_type",
            f"{_RATING.format(key='s_suppkey')} AS rating",
            f"{_LEAD_DAYS.format(key='s_suppkey')} AS default_lead_time_days",
            "CAST(NULL AS STRING) AS payment_terms",
            "TRUE AS is_active",
            f"TIMESTAMP_NTZ '{CREATED_AT} 00:00:00' AS created_at",
        )

    def customers(self) -> DataFrame:
        located = self.table("customer").selectExpr("c_custkey", "CAST(c_nationkey AS BIGINT) AS place_id")
        return located.join(self.view("places"), "place_id", "left").selectExpr(
            "c_custkey AS customer_id",
            "CASE WHEN c_custkey % 20 = 0 THEN 'VIP' WHEN c_custkey % 20 <= 5 THEN 'Premium'"
            " ELSE 'Regular' END AS customer_segment",
            "place_name AS city",
            "place_state AS state",
            "'Earth' AS country",
            f"DATE '{CREATED_AT}' AS signup_date",
            "place_id",
        )

    def products(self) -> DataFrame:
        sources = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(F.min("l_suppkey").alias("supplier_id"))
        )
        return (
            self.table("part")
            .join(sources, "p_partkey", "left")
            .withColumn("sku", X.padded_code("SKU-", F.col("p_partkey")))
            .selectExpr(
                "p_partkey AS product_id",
                "sku",
                "p_name AS product_name",
                f"CAST({_CATEGORY_ID} AS BIGINT) AS category_id",
                "p_brand AS brand",
                f"{_COST} AS unit_cost",
                f"{_PRICE} AS selling_price",
                "CAST(NULL AS DECIMAL(10,2)) AS weight_kg",
                "p_size AS reorder_point",
                "CAST(p_size DIV 2 AS INT) AS safety_stock",
                "supplier_id",
                "p_partkey % 50 <> 0 AS is_active",
                f"TIMESTAMP_NTZ '{CREATED_AT} 00:00:00' AS created_at",
            )
        )

    # order lines

    def plain_lines(self) -> DataFrame:
        """Lines of orders, not numbered, for uses that need no line's id."""
        return self.table("lineitem").filter("l_orderkey IS NOT NULL")

    def lines(self) -> DataFrame:
        """Lines of orders. The filter is stated below the numbering so that every use of it has
        it, and Spark sees one and the same shuffle to reuse.
        """
        return numbered_lines(self.view("plain_lines"))

    _SOLD = (
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "l_returnflag",
        "CAST(abs(l_discount) AS DECIMAL(4,2)) AS discount_rate",
    )

    def sold_lines(self) -> DataFrame:
        """Order lines without prices, for uses that need no join with the products."""
        return self.view("lines").selectExpr("line_id AS order_item_id", *self._SOLD)

    def _priced(self, lines: DataFrame) -> DataFrame:
        prices = self.table("part").selectExpr("p_partkey AS product_id", f"{_PRICE} AS unit_price")
        return lines.join(prices, "product_id", "left")

    def priced_lines(self) -> DataFrame:
        """Order lines with prices but without ids."""
        return self._priced(self.view("plain_lines").selectExpr(*self._SOLD))

    @staticmethod
    def _valued(lines: DataFrame) -> DataFrame:
        return lines.withColumn(
            "discount", F.expr("CAST(round(unit_price * quantity * discount_rate, 2) AS DECIMAL(12,2))")
        ).withColumn("total_amount", F.expr("CAST(unit_price * quantity - discount AS DECIMAL(14,2))"))

    def line_values(self) -> DataFrame:
        """What order lines are worth, without ids."""
        return self._valued(self.view("priced_lines"))

    def valued_lines(self) -> DataFrame:
        return self._valued(self._priced(self.view("sold_lines")))

    def order_items(self) -> DataFrame:
        return self.view("valued_lines").select(*TABLES["order_items"].names)

    # orders

    def order_heads(self) -> DataFrame:
        """Orders without their value, which alone needs the lines."""
        buyers = self.view("customers").selectExpr(
            "customer_id AS o_custkey", "place_id", "city AS place_name", "state AS place_state"
        )
        actual = _after("o_orderdate", "2 + (o_orderkey * 7) % 8", "o_orderkey % 24")
        return self.table("orders").join(buyers, "o_custkey", "left").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CASE WHEN o_orderkey % 61 <> 0 THEN place_id END AS warehouse_id",
            "o_orderdate AS order_date",
            "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 20 = 0 THEN 'RETURNED'"
            " WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'SHIPPED'"
            " WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'CANCELLED'"
            " ELSE 'PROCESSING' END AS order_status",
            "CAST(NULL AS STRING) AS payment_method",
            "place_name AS shipping_city",
            "place_state AS shipping_state",
            f"CASE WHEN o_orderkey % 10 <> 3 THEN {_after('o_orderdate', '2 + o_orderkey % 6')} END"
            " AS promised_delivery_date",
            f"CASE WHEN o_orderstatus = 'F' THEN {actual} END AS actual_delivery_date",
        )

    def orders(self) -> DataFrame:
        totals = self.view("line_values").groupBy("order_id").agg(F.sum("total_amount").alias("lines_total"))
        return (
            self.view("order_heads")
            .join(totals, "order_id", "left")
            .withColumn(
                "order_value",
                F.expr(
                    "CAST(coalesce(lines_total, 0) + CASE WHEN order_id % 25 = 0 THEN 1 ELSE 0 END"
                    " AS DECIMAL(14,2))"
                ),
            )
            .select(*TABLES["orders"].names)
        )

    def shipments(self) -> DataFrame:
        return self.view("orders").selectExpr(
            "order_id AS shipment_id",
            "order_id",
            "coalesce(warehouse_id, 0L) AS warehouse_id",
            "CAST(NULL AS STRING) AS carrier",
            "CASE WHEN order_id % 173 = 0 THEN 'LOST' WHEN order_status = 'CANCELLED' THEN 'CANCELLED'"
            " WHEN order_status IN ('DELIVERED', 'RETURNED') THEN 'DELIVERED'"
            " WHEN order_status = 'SHIPPED' THEN 'IN_TRANSIT' ELSE 'PACKED' END AS shipment_status",
            "CASE WHEN order_status IN ('DELIVERED', 'RETURNED', 'SHIPPED')"
            f" THEN {_after('order_date', '1')} END AS shipped_at",
            f"{_after('order_date', '2 + order_id % 6')} AS estimated_delivery_date",
            "actual_delivery_date",
            "CAST(round(40 + 0.0015 * order_value, 2) AS DECIMAL(12,2)) AS shipping_cost",
        )

    def _returned(self, lines: DataFrame) -> DataFrame:
        delivered = self.view("order_heads").filter("order_status = 'DELIVERED'").select(
            "order_id", "actual_delivery_date"
        )
        reasons = ", ".join(map(_literal, RETURN_REASONS))
        return lines.filter("l_returnflag = 'R'").join(delivered, "order_id").selectExpr(
            "*",
            "order_item_id AS return_id",
            f"{_after('actual_delivery_date', '1 + order_item_id % 30')} AS return_date",
            "greatest(1, CAST(quantity DIV 2 AS INT)) AS return_quantity",
            f"get(array({reasons}), CAST(order_item_id % 7 AS INT)) AS return_reason",
            "CASE WHEN order_item_id % 10 < 7 THEN 'COMPLETED' WHEN order_item_id % 10 < 9 THEN 'APPROVED'"
            " ELSE 'PENDING' END AS return_status",
        )

    def return_facts(self) -> DataFrame:
        """Returns without refunds, for uses that need no prices."""
        return self._returned(self.view("sold_lines")).select(
            "return_id", "order_id", "order_item_id", "product_id", "return_date", "return_quantity"
        )

    def returns(self) -> DataFrame:
        refund = "round(total_amount * return_quantity / quantity, 2)"
        return (
            self._returned(self.view("valued_lines"))
            .withColumn(
                "refund_amount",
                F.expr(
                    f"CAST({refund} + CASE WHEN order_item_id % 89 = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2))"
                ),
            )
            .select(*TABLES["returns"].names)
        )

    # forms with the references of lines alone, for uses that need no line's id

    def sold_keys(self) -> DataFrame:
        return self.view("plain_lines").selectExpr("l_orderkey AS order_id", "l_partkey AS product_id")

    def return_keys(self) -> DataFrame:
        delivered = self.view("order_heads").filter("order_status = 'DELIVERED'").select("order_id")
        returned = self.view("plain_lines").filter("l_returnflag = 'R'")
        return returned.selectExpr("l_orderkey AS order_id", "l_partkey AS product_id").join(delivered, "order_id")

    def po_line_keys(self) -> DataFrame:
        bought = self.view("plain_lines").filter("l_suppkey % 20 <> 7")
        return bought.selectExpr(f"{_PO_ID} AS po_id", "l_partkey AS product_id")

    # purchasing

    def purchase_orders(self) -> DataFrame:
        lead = _LEAD_DAYS.format(key="supplier_id")
        return (
            self.table("lineitem")
            .filter("l_suppkey % 20 <> 7")
            .selectExpr(
                f"{_PO_ID} AS po_id",
                "l_suppkey AS supplier_id",
                "CAST(date_trunc('month', l_shipdate) AS TIMESTAMP_NTZ) AS po_date",
            )
            .distinct()
            .withColumn("sites", self.site_count())
            .selectExpr(
                "po_id",
                "supplier_id",
                "supplier_id % sites AS warehouse_id",
                "po_date",
                f"{_after('po_date', lead)} AS expected_delivery_date",
                f"CASE WHEN po_id % 10 <> 0 THEN {_after('po_date', f'{lead} + po_id % 6 - 2')} END"
                " AS actual_delivery_date",
                f"{_PO_STATUS.format(key='po_id')} AS po_status",
            )
        )

    def po_line_facts(self) -> DataFrame:
        """Purchase lines without cost, for uses that need no join with the products.

        Status follows from the order's id, so the lines need no join with the orders.
        """
        return (
            self.view("lines")
            .filter("l_suppkey % 20 <> 7")
            .selectExpr(
                "line_id AS po_item_id",
                f"{_PO_ID} AS po_id",
                "l_partkey AS product_id",
                "CAST(l_quantity AS INT) + 4 AS ordered_quantity",
                "l_suppkey",
            )
            .withColumn("received_quantity", F.expr(_received("ordered_quantity", "po_item_id")))
        )

    def purchase_order_items(self) -> DataFrame:
        costs = self.table("part").selectExpr("p_partkey AS product_id", f"{_COST} AS product_cost")
        factor = f"(1.06 - 0.01 * {_RATING.format(key='l_suppkey')})"
        surcharge = "CASE WHEN po_item_id % 197 = 0 THEN 1.10 ELSE 1.00 END"
        return self.view("po_line_facts").join(costs, "product_id", "left").selectExpr(
            "po_item_id",
            "po_id",
            "product_id",
            "ordered_quantity",
            "received_quantity",
            f"CAST(round(product_cost * {factor} * {surcharge}, 2) AS DECIMAL(12,2)) AS unit_cost",
        )

    # stock

    def inventory_movements(self) -> DataFrame:
        """All movements of a line in one pass: its receipt, sale and return, and other events.

        The lines are numbered and met with their orders once. A line is then repeated for
        each movement it causes, and the columns follow from the movement's branch, so a use
        that needs two columns computes two. Dates and places are made per line, before it is
        repeated: what Spark pushes towards the lines, such as filters, then holds names and not
        these terms over again, which made code too long for the JVM to compile.
        ``operators.ledger`` derives the first three branches from the tables instead.
        """
        k = "line_id"
        lead = _LEAD_DAYS.format(key="l_suppkey")
        heads = self.view("order_heads").selectExpr(
            "order_id AS l_orderkey", "warehouse_id", "order_date", "order_status", "actual_delivery_date"
        )
        lines = self.view("lines").selectExpr(
            k,
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_returnflag",
            "CAST(l_quantity AS INT) AS units",
            f"{_PO_ID} AS po_id",
            "CAST(date_trunc('month', l_shipdate) AS TIMESTAMP_NTZ) AS month",
        )
        placed = "warehouse_id IS NOT NULL"
        causes = {
            1: "received > 0",
            2: f"{placed} AND order_status <> 'CANCELLED'",
            3: f"{placed} AND l_returnflag = 'R' AND order_status = 'DELIVERED'",
            4: f"{placed} AND {k} % 97 = 0",
            5: f"{placed} AND {k} % 97 = 0",
            6: f"{placed} AND {k} % 97 = 1",
            7: f"{placed} AND {k} % 97 = 2",
        }
        branches = ", ".join(f"CASE WHEN {cause} THEN {branch}L END" for branch, cause in causes.items())
        arrived = (
            f"CASE WHEN po_id % 10 <> 0 THEN {_after('month', f'{lead} + po_id % 6 - 2')}"
            f" ELSE {_after('month', lead)} END"
        )
        returned = _after("actual_delivery_date", f"1 + {k} % 30")
        facts = (
            lines.join(heads, "l_orderkey", "left")
            .withColumn("sites", self.site_count())
            .selectExpr(
                "*",
                f"CASE WHEN l_suppkey % 20 <> 7 THEN {_received('units + 4', k)} END AS received",
                f"{arrived} AS arrived",
                f"{returned} AS returned",
                "l_suppkey % sites AS receiver",
                "(warehouse_id + 1) % sites AS target",
            )
        )
        return (
            facts.selectExpr("*", f"explode(array({branches})) AS branch")
            .filter("branch IS NOT NULL")
            .selectExpr(
                f"branch * {LEDGER_BRANCH} + {k} AS movement_id",
                "CASE branch WHEN 1 THEN receiver WHEN 5 THEN target ELSE warehouse_id END AS warehouse_id",
                "l_partkey AS product_id",
                "CASE branch WHEN 1 THEN 'PURCHASE_RECEIPT' WHEN 2 THEN 'SALE' WHEN 3 THEN 'RETURN'"
                " WHEN 4 THEN 'TRANSFER_OUT' WHEN 5 THEN 'TRANSFER_IN' WHEN 6 THEN 'DAMAGE'"
                " ELSE 'ADJUSTMENT' END AS movement_type",
                "CAST(CASE branch WHEN 1 THEN received WHEN 2 THEN units WHEN 3 THEN greatest(1, units DIV 2)"
                f" WHEN 6 THEN 1 + {k} % 3 WHEN 7 THEN 1 + {k} % 5 ELSE 1 + {k} % 10 END AS INT) AS quantity",
                "CASE branch WHEN 1 THEN arrived WHEN 3 THEN returned ELSE order_date END AS movement_date",
                f"concat(CASE branch WHEN 1 THEN concat('PO-', po_id, '-') WHEN 2 THEN concat('ORD-', l_orderkey, '-')"
                " WHEN 3 THEN 'RET-' WHEN 6 THEN 'DAMAGE-'"
                f" WHEN 7 THEN CASE WHEN {k} % 2 = 0 THEN 'ADJ-IN-' ELSE 'ADJ-OUT-' END ELSE 'TRANSFER-' END, {k})"
                " AS reference_id",
            )
        )

    def inventory(self) -> DataFrame:
        """Two month ends of stock positions, made per product from its warehouse numbers.

        A small file of products makes very many positions, so products are dealt out before. The
        side to broadcast is named: by the size of its file, Spark takes the products for the smaller
        one, and would hold a row per product and warehouse in the driver.
        """
        days = ", ".join(f"DATE '{day}'" for day in SNAPSHOT_DATES)
        sites = F.broadcast(self.view("warehouses").selectExpr("warehouse_id AS w"))
        return (
            self.table("part")
            .select("p_partkey", "p_size")
            .filter("p_partkey % 50 <> 0")
            .repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            .withColumn("sites", self.site_count())
            .selectExpr(
                "p_partkey AS p",
                "CAST(p_size AS BIGINT) AS rp",
                "explode(sequence(0L, sites - 1)) AS w",
            )
            .filter("(w + p) % 40 <> 7")
            .join(sites, "w")
            .selectExpr("*", f"explode(array({days})) AS day")
            .selectExpr(
                "*",
                "CAST(month(day) AS BIGINT) AS month",
                "(31 * w + 17 * p + month(day)) % (3 * rp + 1) AS opening",
                "CASE WHEN (w + p) % 4 = 0 THEN 0 ELSE (7 * w + 3 * p) % 60 END AS received",
                "(13 * w + 7 * p) % (2 * rp + 10) AS sold",
                "CASE WHEN (w + p) % 10 = 0 THEN 3 ELSE 0 END AS back",
                "CASE WHEN (w + p) % 20 = 0 THEN p % 21 - 10 ELSE 0 END AS fix",
            )
            .selectExpr(
                "*",
                "greatest(0, opening + received - sold + back + fix)"
                " + CASE WHEN (3 * w + p) % 50 = 0 THEN 1 ELSE 0 END AS closing",
            )
            .selectExpr(
                "(month * 100 + w) * 1000000000000 + p AS inventory_id",
                "w AS warehouse_id",
                "p AS product_id",
                "day AS snapshot_date",
                "CAST(opening AS INT) AS opening_stock",
                "CAST(received AS INT) AS received_quantity",
                "CAST(sold AS INT) AS sold_quantity",
                "CAST(back AS INT) AS returned_quantity",
                "CAST(fix AS INT) AS adjustment_quantity",
                "CAST(closing AS INT) AS closing_stock",
                "CAST(least(closing, (5 * w + 11 * p) % (rp + 1)) AS INT) AS reserved_quantity",
            )
        )


def corrupted_movements(movements: DataFrame) -> DataFrame:
    """The ledger with every kind of fault the movement checks look for."""
    return (
        movements.withColumn("k", F.col("movement_id") % LEDGER_BRANCH)
        .selectExpr(
            "movement_id",
            "CASE WHEN k % 109 <> 0 THEN warehouse_id END AS warehouse_id",
            "CASE WHEN k % 107 = 0 THEN -1L ELSE product_id END AS product_id",
            "CASE WHEN k % 103 = 0 THEN 'BOGUS' ELSE movement_type END AS movement_type",
            "CASE WHEN k % 101 = 0 THEN -quantity WHEN k % 137 = 0 THEN quantity + 1"
            " ELSE quantity END AS quantity",
            "CASE WHEN k % 127 = 0 THEN TIMESTAMP_NTZ '2999-01-01 00:00:00' ELSE movement_date END"
            " AS movement_date",
            "CASE WHEN k % 113 = 0 THEN NULL WHEN k % 131 = 0 THEN concat('X', reference_id)"
            " ELSE reference_id END AS reference_id",
            "explode(CASE WHEN k % 139 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
        )
        .drop("copy")
    )


def faulty_copies(frame: DataFrame, faults: list[tuple[str, str]], chosen: Column) -> DataFrame:
    """A frame and, of every chosen row, one copy per fault, with that column replaced by a SQL
    value, and one without any. A row and its copies are made together, so the frame is read once."""
    arms: dict[str, str] = {}
    for number, (column, value) in enumerate(faults):
        arms[column] = arms.get(column, "") + f" WHEN {number} THEN {value}"
    kinds = {field.name: field.dataType.simpleString() for field in frame.schema.fields}
    columns = [
        f"CAST(CASE fault{arms[name]} ELSE {name} END AS {kinds[name]}) AS {name}" if name in arms else name
        for name in frame.columns
    ]
    as_is = F.lit(-1)
    kept = F.when(chosen, F.sequence(as_is, F.lit(len(faults)))).otherwise(F.array(as_is))
    return frame.withColumn("fault", F.explode(kept)).selectExpr(*columns)


def _faults_of(table: str) -> list[tuple[str, str]]:
    """What breaks each rule of a table: missing values, references to nothing, and values out of range."""
    faults = [(field.name, "NULL") for field in TABLES[table].fields if not field.nullable]
    faults += [(ref.column, "-1") for ref in REFERENCES if ref.child == table]
    for rule in VALUE_RULES.get(table, ()):
        faults.append((rule.split()[0], "'BOGUS'" if " IN (" in rule else "-1"))
    return faults


def every_97th(frame: DataFrame, key: str) -> Column:
    """Rows whose key is divisible by 97, and those with the least key."""
    return (F.col(key) % 97 == 0) | (F.col(key) == frame.agg(F.min(key)).scalar())


def broken_tables(tables: Relations) -> Relations:
    """The operational tables with rows that break each of their rules."""
    return tables.extended(
        **{
            name: faulty_copies(tables[name], _faults_of(name), every_97th(tables[name], key))
            for name, key in PRIMARY_KEYS.items()
        }
    )


_conformed: dict[tuple[str, str], Relations] = {}


def conformed(spark: SparkSession, root: str) -> Relations:
    """The thirteen operational tables, plus the narrow forms some operators need.

    The plans are built once per session and folder; no data is held.
    """
    key = (spark.sparkContext.applicationId, root)
    if key not in _conformed:
        views = _Views(spark, root)
        narrow = (
            "order_heads", "sold_lines", "priced_lines", "line_values", "return_facts", "po_line_facts",
            "sold_keys", "return_keys", "po_line_keys",
        )
        loaders = {name: (lambda name=name: views.view(name)) for name in (*TABLES, *narrow)}
        loaders["customers"] = lambda: views.view("customers").drop("place_id")
        _conformed[key] = Relations(loaders)
    return _conformed[key]
