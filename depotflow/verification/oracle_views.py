"""The operational tables as SQL views over TPC-H-like tables, written apart from the Spark side."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "li": """
        SELECT *,
               bucket * 59000003 - 1 + row_number() OVER (
                   PARTITION BY bucket
                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS k,
               l_suppkey * 1000 + (year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS po_id
        FROM (SELECT *, ('0x' || left(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 6))::BIGINT
                        AS bucket
              FROM lineitem)""",
    "sites": """SELECT (max(n_nationkey) + 1)::BIGINT AS n FROM nation""",
    "types": """
        SELECT DISTINCT p_type AS type_name, coalesce(label, p_type) AS label,
               coalesce(number, 1000 + ('0x' || left(md5(p_type), 10))::BIGINT) AS type_id
        FROM part
        LEFT JOIN (VALUES ('ECONOMY', 1, 'Footwear'), ('LARGE', 2, 'Beauty'), ('MEDIUM', 3, 'Cameras'),
                          ('PROMO', 4, 'Audio'), ('SMALL', 5, 'Furniture'), ('STANDARD', 6, 'Beverages'))
                  AS fixed(name, number, label) ON name = p_type
        WHERE p_type IS NOT NULL""",
    "categories": """
        SELECT DISTINCT type_id::BIGINT AS category_id, label AS category_name,
               'Dept' || (type_id % 3)::VARCHAR AS department
        FROM part JOIN types ON p_type = type_name""",
    "warehouses": """
        SELECT n_nationkey::BIGINT AS warehouse_id, n_name AS warehouse_name, n_name AS city, r_name AS state,
               'Earth' AS country, NULL::VARCHAR AS warehouse_type,
               (100000 + 1000 * n_nationkey)::BIGINT AS capacity_units,
               (40000 + 100 * n_nationkey)::DECIMAL(12,2) AS operating_cost_per_day,
               NULL::DECIMAL(9,6) AS latitude, NULL::DECIMAL(9,6) AS longitude, NULL::DATE AS opened_at
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, 'Earth' AS country, NULL::VARCHAR AS state,
               NULL::VARCHAR AS city, NULL::VARCHAR AS supplier_type,
               ((200 + (s_suppkey * 37) % 301) / 100.0)::DECIMAL(3,2) AS rating,
               (3 + s_suppkey % 18)::INTEGER AS default_lead_time_days, NULL::VARCHAR AS payment_terms,
               TRUE AS is_active, TIMESTAMP '1995-01-01' AS created_at
        FROM supplier""",
    "customers": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 20 = 0 THEN 'VIP' WHEN c_custkey % 20 <= 5 THEN 'Premium' ELSE 'Regular' END
                   AS customer_segment,
               n_name AS city, r_name AS state, 'Earth' AS country, DATE '1995-01-01' AS signup_date,
               n_nationkey AS nation
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id,
               'SKU-' || CASE WHEN length(p_partkey::VARCHAR) < 6 THEN lpad(p_partkey::VARCHAR, 6, '0')
                              ELSE p_partkey::VARCHAR END AS sku,
               p_name AS product_name, type_id::BIGINT AS category_id, p_brand AS brand,
               round(p_retailprice::DECIMAL(12,2) * 0.80, 2)::DECIMAL(12,2) AS unit_cost,
               p_retailprice::DECIMAL(12,2) AS selling_price, NULL::DECIMAL(10,2) AS weight_kg,
               p_size AS reorder_point, (p_size // 2)::INTEGER AS safety_stock, sup AS supplier_id,
               p_partkey % 50 <> 0 AS is_active, TIMESTAMP '1995-01-01' AS created_at
        FROM part
        LEFT JOIN types ON p_type = type_name
        LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS sup FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
    "items_wide": """
        SELECT k AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
               l_quantity::INTEGER AS quantity, selling_price AS unit_price,
               abs(l_discount)::DECIMAL(4,2) AS discount_rate,
               round(selling_price * l_quantity::INTEGER * abs(l_discount)::DECIMAL(4,2), 2)::DECIMAL(12,2)
                   AS discount,
               l_returnflag
        FROM li LEFT JOIN products ON l_partkey = product_id""",
    "order_items": """
        SELECT order_item_id, order_id, product_id, quantity, unit_price, discount,
               (unit_price * quantity - discount)::DECIMAL(14,2) AS total_amount
        FROM items_wide""",
    "customer_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE nation END::BIGINT AS warehouse_id,
               o_orderdate AS order_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 20 = 0 THEN 'RETURNED'
                    WHEN o_orderstatus = 'F' THEN 'DELIVERED'
                    WHEN o_orderstatus = 'O' THEN 'SHIPPED'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'CANCELLED'
                    ELSE 'PROCESSING' END AS order_status,
               NULL::VARCHAR AS payment_method,
               (coalesce(lines_total, 0) + CASE WHEN o_orderkey % 25 = 0 THEN 1 ELSE 0 END)::DECIMAL(14,2)
                   AS order_value,
               city AS shipping_city, state AS shipping_state,
               CASE WHEN o_orderkey % 10 = 3 THEN NULL
                    ELSE o_orderdate + to_days((2 + o_orderkey % 6)::INTEGER) END AS promised_delivery_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN o_orderdate + to_days((2 + (o_orderkey * 7) % 8)::INTEGER)
                                     + to_hours((o_orderkey % 24)::INTEGER) END AS actual_delivery_date
        FROM orders
        LEFT JOIN customers ON customer_id = o_custkey
        LEFT JOIN (SELECT order_id AS oid, sum(total_amount) AS lines_total FROM order_items GROUP BY 1)
               ON oid = o_orderkey""",
    "purchase_orders": """
        SELECT po_id, supplier AS supplier_id, (supplier % (SELECT n FROM sites))::BIGINT AS warehouse_id, month_start AS po_date,
               month_start + to_days((3 + supplier % 18)::INTEGER) AS expected_delivery_date,
               CASE WHEN po_id % 10 = 0 THEN NULL
                    ELSE month_start + to_days((3 + supplier % 18 + po_id % 6 - 2)::INTEGER) END
                   AS actual_delivery_date,
               CASE WHEN po_id % 10 = 0 THEN 'CANCELLED' WHEN po_id % 10 IN (1, 2) THEN 'PARTIALLY_RECEIVED'
                    ELSE 'RECEIVED' END AS po_status
        FROM (SELECT DISTINCT po_id, l_suppkey AS supplier, date_trunc('month', l_shipdate)::TIMESTAMP AS month_start
              FROM li WHERE l_suppkey % 20 <> 7)""",
    "purchase_order_items": """
        SELECT po_item_id, po_id, product_id, ordered_quantity,
               CASE po_status WHEN 'CANCELLED' THEN 0
                              WHEN 'PARTIALLY_RECEIVED' THEN ordered_quantity // 2
                              ELSE ordered_quantity - CASE WHEN po_item_id % 211 = 0 THEN 1 ELSE 0 END
               END::INTEGER AS received_quantity,
               unit_cost
        FROM (SELECT k AS po_item_id, po.po_id, l_partkey AS product_id,
                     (l_quantity::INTEGER + 4)::INTEGER AS ordered_quantity, po_status,
                     round(p.unit_cost * (1.06 - 0.01 * s.rating)
                           * CASE WHEN k % 197 = 0 THEN 1.10 ELSE 1.00 END, 2)::DECIMAL(12,2) AS unit_cost
              FROM li
              JOIN purchase_orders po ON po.po_id = li.po_id AND po.supplier_id = li.l_suppkey
              LEFT JOIN products p ON p.product_id = l_partkey
              LEFT JOIN suppliers s ON s.supplier_id = l_suppkey)""",
    "shipments": """
        SELECT order_id AS shipment_id, order_id, coalesce(warehouse_id, 0)::BIGINT AS warehouse_id,
               NULL::VARCHAR AS carrier,
               CASE WHEN order_id % 173 = 0 THEN 'LOST'
                    WHEN order_status = 'CANCELLED' THEN 'CANCELLED'
                    WHEN order_status IN ('DELIVERED', 'RETURNED') THEN 'DELIVERED'
                    WHEN order_status = 'SHIPPED' THEN 'IN_TRANSIT' ELSE 'PACKED' END AS shipment_status,
               CASE WHEN order_status IN ('DELIVERED', 'RETURNED', 'SHIPPED') THEN order_date + to_days(1) END
                   AS shipped_at,
               order_date + to_days((2 + order_id % 6)::INTEGER) AS estimated_delivery_date,
               actual_delivery_date,
               round(40 + 0.0015 * order_value, 2)::DECIMAL(12,2) AS shipping_cost
        FROM customer_orders""",
    "returns": """
        SELECT order_item_id AS return_id, order_id, order_item_id, product_id,
               delivered_at + to_days((1 + order_item_id % 30)::INTEGER) AS return_date,
               back AS return_quantity,
               (['DAMAGED', 'DEFECTIVE', 'WRONG_ITEM', 'SIZE_ISSUE', 'CUSTOMER_CHANGED_MIND', 'LATE_DELIVERY',
                 'NOT_AS_EXPECTED'])[(order_item_id % 7 + 1)::INTEGER] AS return_reason,
               ((2 * cents * back + quantity) // (2 * quantity) / 100.0
                   + CASE WHEN order_item_id % 89 = 0 THEN 1 ELSE 0 END)::DECIMAL(14,2) AS refund_amount,
               CASE WHEN order_item_id % 10 < 7 THEN 'COMPLETED' WHEN order_item_id % 10 < 9 THEN 'APPROVED'
                    ELSE 'PENDING' END AS return_status
        FROM (SELECT i.*, o.actual_delivery_date AS delivered_at,
                     greatest(1, i.quantity // 2)::INTEGER AS back,
                     ((i.unit_price * i.quantity - i.discount) * 100)::BIGINT AS cents
              FROM items_wide i JOIN customer_orders o USING (order_id)
              WHERE i.l_returnflag = 'R' AND o.order_status = 'DELIVERED')""",
    "line_moves": """
        SELECT i.order_item_id AS id, i.order_id, i.product_id, i.quantity, o.warehouse_id AS site,
               o.order_date AS happened, o.order_status
        FROM order_items i JOIN customer_orders o USING (order_id) WHERE o.warehouse_id IS NOT NULL""",
    "booked": """
        SELECT 1000000000000000 + po_item_id AS movement_id, warehouse_id, product_id,
               'PURCHASE_RECEIPT' AS movement_type, received_quantity AS quantity,
               coalesce(actual_delivery_date, expected_delivery_date) AS movement_date,
               'PO-' || po_id || '-' || po_item_id AS reference_id
        FROM purchase_order_items JOIN purchase_orders USING (po_id) WHERE received_quantity > 0
        UNION ALL
        SELECT 2000000000000000 + id, site, product_id, 'SALE', quantity, happened, 'ORD-' || order_id || '-' || id
        FROM line_moves WHERE order_status <> 'CANCELLED'
        UNION ALL
        SELECT 3000000000000000 + return_id, warehouse_id, product_id, 'RETURN', return_quantity, return_date,
               'RET-' || return_id
        FROM returns JOIN customer_orders USING (order_id) WHERE warehouse_id IS NOT NULL""",
    "inventory_movements": """
        SELECT * FROM booked
        UNION ALL
        SELECT 4000000000000000 + id, site, product_id, 'TRANSFER_OUT', (1 + id % 10)::INTEGER, happened,
               'TRANSFER-' || id FROM line_moves WHERE id % 97 = 0
        UNION ALL
        SELECT 5000000000000000 + id, (site + 1) % (SELECT n FROM sites), product_id, 'TRANSFER_IN', (1 + id % 10)::INTEGER, happened,
               'TRANSFER-' || id FROM line_moves WHERE id % 97 = 0
        UNION ALL
        SELECT 6000000000000000 + id, site, product_id, 'DAMAGE', (1 + id % 3)::INTEGER, happened, 'DAMAGE-' || id
        FROM line_moves WHERE id % 97 = 1
        UNION ALL
        SELECT 7000000000000000 + id, site, product_id, 'ADJUSTMENT', (1 + id % 5)::INTEGER, happened,
               CASE WHEN id % 2 = 0 THEN 'ADJ-IN-' ELSE 'ADJ-OUT-' END || id
        FROM line_moves WHERE id % 97 = 2""",
    "faulty": """
        SELECT movement_id,
               CASE WHEN k % 109 = 0 THEN NULL ELSE warehouse_id END AS warehouse_id,
               CASE WHEN k % 107 = 0 THEN -1 ELSE product_id END AS product_id,
               CASE WHEN k % 103 = 0 THEN 'BOGUS' ELSE movement_type END AS movement_type,
               CASE WHEN k % 101 = 0 THEN -quantity WHEN k % 137 = 0 THEN quantity + 1 ELSE quantity END AS quantity,
               CASE WHEN k % 127 = 0 THEN TIMESTAMP '2999-01-01' ELSE movement_date END AS movement_date,
               CASE WHEN k % 113 = 0 THEN NULL WHEN k % 131 = 0 THEN 'X' || reference_id ELSE reference_id END
                   AS reference_id
        FROM (SELECT *, movement_id % 1000000000000000 AS k FROM inventory_movements)""",
    "dirty_movements": """
        SELECT * FROM faulty
        UNION ALL
        SELECT * FROM faulty WHERE movement_id % 1000000000000000 % 139 = 0""",
    "inventory": """
        SELECT (mon * 100 + w) * 1000000000000 + p AS inventory_id, w AS warehouse_id, p AS product_id,
               snapshot_date, opening::INTEGER AS opening_stock, received::INTEGER AS received_quantity,
               sold::INTEGER AS sold_quantity, back::INTEGER AS returned_quantity,
               fix::INTEGER AS adjustment_quantity, closing::INTEGER AS closing_stock,
               least(closing, (5 * w + 11 * p) % (rp + 1))::INTEGER AS reserved_quantity
        FROM (SELECT *, greatest(0, opening + received - sold + back + fix)
                        + CASE WHEN (3 * w + p) % 50 = 0 THEN 1 ELSE 0 END AS closing
              FROM (SELECT w, p, rp, mon, snapshot_date,
                           (31 * w + 17 * p + mon) % (3 * rp + 1) AS opening,
                           CASE WHEN (w + p) % 4 = 0 THEN 0 ELSE (7 * w + 3 * p) % 60 END AS received,
                           (13 * w + 7 * p) % (2 * rp + 10) AS sold,
                           CASE WHEN (w + p) % 10 = 0 THEN 3 ELSE 0 END AS back,
                           CASE WHEN (w + p) % 20 = 0 THEN p % 21 - 10 ELSE 0 END AS fix
                    FROM (SELECT warehouse_id AS w, product_id AS p, reorder_point::BIGINT AS rp,
                                 snapshot_date, month(snapshot_date) AS mon
                          FROM warehouses, products,
                               (VALUES (DATE '2001-11-30'), (DATE '2001-12-31')) AS days(snapshot_date)
                          WHERE is_active AND (warehouse_id + product_id) % 40 <> 7)))""",
    # data products
    "m1": """
        SELECT movement_id, movement_date::DATE AS movement_date, movement_date AS movement_timestamp,
               year(movement_date)::INTEGER AS movement_year, month(movement_date)::INTEGER AS movement_month,
               week(movement_date)::INTEGER AS movement_week, movement_type,
               CASE WHEN movement_type IN ('PURCHASE_RECEIPT', 'RETURN', 'TRANSFER_IN') THEN 'inbound'
                    WHEN movement_type IN ('SALE', 'DAMAGE', 'TRANSFER_OUT') THEN 'outbound'
                    ELSE 'adjustment' END AS movement_direction,
               quantity,
               CASE WHEN movement_type IN ('PURCHASE_RECEIPT', 'RETURN', 'TRANSFER_IN') THEN quantity
                    WHEN movement_type IN ('SALE', 'DAMAGE', 'TRANSFER_OUT') THEN -quantity
                    ELSE 0 END AS signed_quantity,
               reference_id, m.warehouse_id, warehouse_name, city AS warehouse_city, state AS warehouse_state,
               m.product_id, sku, product_name, p.category_id, category_name
        FROM inventory_movements m
        LEFT JOIN products p USING (product_id)
        LEFT JOIN categories c ON c.category_id = p.category_id
        LEFT JOIN warehouses w ON w.warehouse_id = m.warehouse_id""",
    "m2": """
        SELECT warehouse_id, warehouse_name, product_id, sku, product_name, category_id, category_name,
               movement_date, movement_year, movement_month,
               sum(CASE WHEN movement_direction = 'inbound' THEN quantity ELSE 0 END)::BIGINT AS inbound_quantity,
               sum(CASE WHEN movement_direction = 'outbound' THEN quantity ELSE 0 END)::BIGINT AS outbound_quantity,
               sum(signed_quantity)::BIGINT AS net_quantity, count(movement_id) AS movement_count
        FROM m1 GROUP BY ALL""",
    "m3": """
        SELECT i.*, sku, product_name, p.category_id, reorder_point, category_name, warehouse_name,
               w.city AS warehouse_city, w.state AS warehouse_state,
               year(snapshot_date)::INTEGER AS snapshot_year, month(snapshot_date)::INTEGER AS snapshot_month,
               closing_stock - reserved_quantity AS available_stock,
               CASE WHEN closing_stock - reserved_quantity <= 0 THEN 'STOCK_OUT'
                    WHEN closing_stock - reserved_quantity <= reorder_point THEN 'REORDER'
                    ELSE 'HEALTHY' END AS stock_status
        FROM inventory i
        LEFT JOIN products p ON p.product_id = i.product_id
        LEFT JOIN categories c ON c.category_id = p.category_id
        LEFT JOIN warehouses w ON w.warehouse_id = i.warehouse_id""",
    "m4": """
        SELECT snapshot_date, warehouse_id, warehouse_name, warehouse_city, warehouse_state,
               count(*) AS inventory_positions,
               count(*) FILTER (WHERE stock_status = 'STOCK_OUT') AS stockout_positions,
               round(count(*) FILTER (WHERE stock_status = 'STOCK_OUT')::DOUBLE / nullif(count(*), 0), 4)
                   AS stockout_rate,
               sum(available_stock)::BIGINT AS available_units
        FROM m3 GROUP BY 1, 2, 3, 4, 5""",
    "m5": """
        WITH units AS (
            SELECT po_id, sum(ordered_quantity) AS ordered, sum(received_quantity) AS received
            FROM purchase_order_items GROUP BY po_id
        ), per_supplier AS (
            SELECT supplier_id, count(*) AS pos, count(actual_delivery_date) AS delivered,
                   count(*) FILTER (WHERE actual_delivery_date <= expected_delivery_date) AS on_time,
                   sum(ordered) AS ordered, sum(received) AS received
            FROM purchase_orders LEFT JOIN units USING (po_id) GROUP BY supplier_id
        )
        SELECT s.supplier_id, s.supplier_name, coalesce(pos, 0) AS purchase_order_count,
               coalesce(delivered, 0) AS delivered_purchase_order_count,
               coalesce(on_time, 0) AS on_time_purchase_order_count,
               CASE WHEN delivered > 0 THEN round(on_time::DOUBLE / delivered, 4) END AS on_time_delivery_rate,
               coalesce(ordered, 0)::BIGINT AS ordered_units, coalesce(received, 0)::BIGINT AS received_units,
               CASE WHEN ordered > 0 THEN round(coalesce(received, 0)::DOUBLE / ordered, 4) END AS receipt_fill_rate
        FROM suppliers s LEFT JOIN per_supplier USING (supplier_id)""",
    "m6": """
        SELECT delivery_date, n AS delivered_order_count, promised AS orders_with_promised_date,
               on_time AS on_time_order_count,
               round(on_time::DOUBLE / nullif(promised, 0), 4) AS on_time_delivery_rate,
               ((2 * seconds * 100 + 86400 * n) // (2 * 86400 * n)) / 100.0::DOUBLE AS average_order_cycle_days
        FROM (SELECT actual_delivery_date::DATE AS delivery_date, count(*) AS n,
                     count(promised_delivery_date) AS promised,
                     sum(CASE WHEN actual_delivery_date <= promised_delivery_date THEN 1 ELSE 0 END)::BIGINT AS on_time,
                     sum(date_diff('second', order_date, actual_delivery_date))::BIGINT AS seconds
              FROM customer_orders WHERE actual_delivery_date IS NOT NULL GROUP BY 1)""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", sql)))
    for name in VIEWS:
        if name in words and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None


def with_views(body: str) -> str:
    """A query with the views it uses, and the views those use, in front of it."""
    found: dict[str, None] = {}
    _needed(body, found)
    ctes = [f"{name} AS ({VIEWS[name]})" for name in found]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
