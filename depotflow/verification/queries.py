"""Every operator as a runnable query over one folder of TPC-H-like tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotflow.functions import columns as X
from depotflow.model import CONTRACTS, DAILY_METRICS, MOVEMENTS_PROCESSED, RECEIPT_REFERENCE, SNAPSHOT_ENRICHED, TABLES
from depotflow.operators import audits as R
from depotflow.operators import inventory as I
from depotflow.operators import ledger as L
from depotflow.operators import marts as M
from depotflow.operators import movement_audit as A
from depotflow.operators import probes
from depotflow.operators import profiles as P
from depotflow.operators import quality as Q
from depotflow.operators import standardize as S
from depotflow.plans import checks, commits, conform
from depotflow.plans import publish as W
from depotflow.plans.loads import load_absent, loaded
from depotflow.plans.pipeline import RunConfig, declared_test_results, marts, months, run_pipeline, stage_daily, stage_movements, stage_snapshot
from depotflow.plans.publish import publish, published
from depotflow.session import scratch_path, stashed
from depotflow.sources import ranges, storage
from depotflow.sources.files import read_dataset, read_landing, write_dataset, write_landing, write_parts
from depotflow.sources.relations import Relations, parquet_relations

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2010, 1, 1)
SNAPSHOT_DATE = "2001-12-31"

_queries: dict[str, Query] = {}


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _day():
    return F.lit(SNAPSHOT_DATE).cast("date")


def _query(build: Callable[[Relations], DataFrame]) -> Callable[[Relations], DataFrame]:
    """Register a query over the operational tables under the function's name."""
    _queries[build.__name__] = lambda spark, root: build(conform.conformed(spark, root))
    return build


def _query_with_session(build: Query) -> Query:
    _queries[build.__name__] = build
    return build


def _units_only(tables: Relations) -> Relations:
    """The same tables in forms without money columns, which save the joins behind prices."""
    return tables.extended(
        orders=tables["order_heads"],
        order_items=tables["sold_lines"],
        returns=tables["return_facts"],
        purchase_order_items=tables["po_line_facts"],
    )


def _keys_only(tables: Relations) -> Relations:
    """The same tables where those made of order lines have the references of the lines alone."""
    return tables.extended(
        orders=tables["order_heads"],
        order_items=tables["sold_keys"],
        returns=tables["return_keys"],
        purchase_order_items=tables["po_line_keys"],
    )


def _with_faults(tables: Relations) -> Relations:
    return tables.extended(
        inventory_movements=conform.corrupted_movements(tables["inventory_movements"])
    )


def _dims(tables: Relations) -> dict[str, DataFrame]:
    return {name: tables[name] for name in ("products", "warehouses", "categories")}


# --- data products ------------------------------------------------------------------------


@_query
def m1_movements_processed(tables):
    return I.enriched_movements(tables["inventory_movements"], **_dims(tables))


@_query
def m2_daily_metrics(tables):
    return I.daily_metrics_from_sources(tables["inventory_movements"], **_dims(tables))


@_query
def m3_snapshot_enriched(tables):
    return I.enriched_snapshot(tables["inventory"], **_dims(tables))


@_query
def m4_stockout_daily(tables):
    return M.stockout_daily(m3_snapshot_enriched(tables))


@_query
def m5_supplier_performance(tables):
    tables = _units_only(tables)
    return M.supplier_performance(
        tables["suppliers"], tables["purchase_orders"], tables["purchase_order_items"]
    )


@_query
def m6_delivery_daily(tables):
    return M.delivery_performance_daily(tables["orders"])


@_query
def stg_movements(tables):
    return I.staged_movements(m1_movements_processed(tables))


@_query
def stg_daily(tables):
    return I.staged_daily_metrics(m2_daily_metrics(tables))


@_query
def stg_snapshot(tables):
    return I.staged_snapshot(m3_snapshot_enriched(tables))


# --- typed source projections ------------------------------------------------------------------


@_query
def typed_inventory(tables):
    return S.typed_inventory(tables["inventory"])


@_query
def typed_movements(tables):
    return S.typed_movements(tables["inventory_movements"])


@_query
def typed_products(tables):
    return S.typed_products(tables["products"])


@_query
def typed_warehouses(tables):
    return S.typed_warehouses(tables["warehouses"])


@_query
def typed_categories(tables):
    return S.typed_categories(tables["categories"])


# --- source checks -------------------------------------------------------------------------


@_query
def source_gate(tables):
    checks.require_tables(tables)
    return checks.source_counts(_keys_only(tables))


@_query
def dq_referential(tables):
    return checks.source_references(_keys_only(tables))


@_query
def dq_referential_dirty(tables):
    return checks.source_references(_with_faults(_keys_only(tables)))


@_query
def dq_movements(tables):
    return checks.movement_checks(tables["inventory_movements"], _as_of())


@_query
def dq_movements_dirty(tables):
    return checks.movement_checks(_with_faults(tables)["inventory_movements"], _as_of())


def _outcomes(tables: Relations) -> DataFrame:
    """What the probes of the gates found; (check, state, fault), as which row is hit first is left open."""
    found = probes.probed(
        [*checks.reference_probes(tables), *checks.movement_probes(tables["inventory_movements"], _as_of())]
    )
    rows = [(outcome.check, outcome.state, outcome.fault if outcome.state == probes.HIT else None) for outcome in found]
    return SparkSession.active().createDataFrame(rows, "check string, state string, fault string")


@_query
def dq_first_failure(tables):
    return _outcomes(_keys_only(tables))


@_query
def dq_first_failure_dirty(tables):
    """Sound rows, but ids that occur twice: the scan finds nothing, the grouping does, no join runs."""
    moves = tables["inventory_movements"]
    twice = moves.unionByName(moves.filter(F.pmod("movement_id", F.lit(97)) == 0))
    return _outcomes(_keys_only(tables).extended(inventory_movements=twice))


@_query
def dq_faulty_rows(tables):
    return checks.faulty_movements(_with_faults(tables)["inventory_movements"], _as_of())


@_query
def dq_duplicate_ids(tables):
    return Q.duplicated_keys(_with_faults(tables)["inventory_movements"], ["movement_id"])


@_query
def dq_orphan_rows_products(tables):
    moves = _with_faults(tables)["inventory_movements"]
    return Q.unreferenced_rows(moves, "product_id", tables["products"], "product_id")


@_query
def dq_orphan_rows_warehouses(tables):
    moves = _with_faults(tables)["inventory_movements"]
    return Q.unreferenced_rows(moves, "warehouse_id", tables["warehouses"], "warehouse_id")


@_query
def reference_keys(tables):
    """The numbers inside movement references, and whether a receipt's is well formed."""
    reference = F.col("reference_id")
    return _with_faults(tables)["inventory_movements"].select(
        "movement_id",
        "reference_id",
        X.reference_part(reference, 2).alias("second"),
        X.reference_part(reference, 3).alias("third"),
        reference.rlike(RECEIPT_REFERENCE).alias("is_receipt"),
    )


_RANGES = 16


@_query_with_session
def scan_ranges(spark, root):
    """Do ranges at sampled quantiles deal out the rows of each table evenly, each row once?

    ``even``: but for its hottest key, no range has more than twice a range's share of the rows.
    """
    parts = []
    for name, key in (("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("orders", "o_custkey"), ("part", "p_partkey")):
        frame = spark.read.parquet(f"{root}/{name}.parquet")
        bounds = ranges.key_quantiles(frame, key, _RANGES, fraction=0.5)
        depths = ranges.range_depths(frame, key, bounds)
        parts.append(
            depths.agg(
                F.sum("rows").alias("table_rows"),
                F.sum("met_once").alias("rows_met_once"),
                (F.max(F.col("rows") - F.col("hottest")) * _RANGES <= 2 * F.sum("rows")).alias("even"),
            ).withColumn("scan", F.lit(f"{name}.{key}"))
        )
    return Q.all_checks(parts)


# --- movements against their documents ---------------------------------------------------------


def _purchase_refs(tables):
    return A.purchase_reference_check(
        tables["inventory_movements"], tables["purchase_order_items"], tables["purchase_orders"]
    )


def _sale_refs(tables):
    return A.sale_reference_check(tables["inventory_movements"], tables["order_items"], tables["orders"])


def _return_refs(tables):
    return A.return_reference_check(tables["inventory_movements"], tables["returns"], tables["orders"])


def _transfers(tables):
    return A.transfer_check(tables["inventory_movements"])


def _adjustments(tables):
    return A.adjustment_check(tables["inventory_movements"])


for _name, _check in {
    "dq_purchase_refs": _purchase_refs,
    "dq_sale_refs": _sale_refs,
    "dq_return_refs": _return_refs,
    "dq_transfers": _transfers,
    "dq_adjustments": _adjustments,
}.items():
    _queries[_name] = lambda spark, root, c=_check: c(_units_only(conform.conformed(spark, root)))
    _queries[f"{_name}_dirty"] = lambda spark, root, c=_check: c(
        _with_faults(_units_only(conform.conformed(spark, root)))
    )


@_query
def dq_unpaired_transfers(tables):
    return A.unpaired_transfers(_with_faults(tables)["inventory_movements"])


@_query
def movement_audit_dirty(tables):
    return checks.movement_audit(_with_faults(_units_only(tables)), _as_of())


# --- contracts and outputs ----------------------------------------------------------------------


@_query
def dq_table_contract(tables):
    return checks.table_contract(tables)


@_query
def dq_required_values(tables):
    return checks.required_values(tables)


@_query
def dq_table_contract_dirty(tables):
    return checks.table_contract(conform.broken_tables(tables))


@_query
def dq_required_values_dirty(tables):
    return checks.required_values(conform.broken_tables(tables))


@_query
def dq_declared_tests_dirty(tables):
    """The declared tests over staged relations and marts with rows that break each of them."""
    enriched = m1_movements_processed(tables)
    staged = {
        "stg_inventory_movements": (enriched, "movement_id", "movement_id movement_date warehouse_id product_id movement_type"),
        "stg_inventory_daily_metrics": (m2_daily_metrics(tables), "product_id", "warehouse_id product_id movement_date movement_count"),
        "stg_inventory_snapshot": (m3_snapshot_enriched(tables), "inventory_id", "inventory_id warehouse_id product_id snapshot_date stock_status"),
        "fct_inventory_stockout_daily": (m4_stockout_daily(tables), "warehouse_id", "snapshot_date warehouse_id"),
        "fct_supplier_performance": (m5_supplier_performance(tables), "supplier_id", "supplier_id supplier_name"),
        "fct_order_delivery_performance_daily": (m6_delivery_daily(_units_only(tables)), "delivered_order_count", "delivery_date"),
    }
    wrong = {
        "stg_inventory_movements": [("movement_type", "'BOGUS'"), ("warehouse_id", "-1"), ("product_id", "-1")],
        "stg_inventory_snapshot": [("stock_status", "'BOGUS'")],
    }
    broken = {
        name: conform.faulty_copies(
            frame, [(column, "NULL") for column in required.split()] + wrong.get(name, []), conform.every_97th(frame, key)
        )
        for name, (frame, key, required) in staged.items()
    }
    return declared_test_results(tables.extended(**broken))


@_query
def dq_staging_keys(tables):
    return checks.staging_keys(m1_movements_processed(tables), m2_daily_metrics(tables), m3_snapshot_enriched(tables))


@_query
def dq_marts(tables):
    return checks.mart_checks(
        m4_stockout_daily(tables), m5_supplier_performance(tables), m6_delivery_daily(_units_only(tables))
    )


@_query
def dq_reconcile(tables):
    return checks.reconciliation_check(m1_movements_processed(tables), m2_daily_metrics(tables))


@_query
def dq_declared_tests(tables):
    staged = _units_only(tables).extended(
        stg_inventory_movements=stg_movements(tables),
        stg_inventory_daily_metrics=stg_daily(tables),
        stg_inventory_snapshot=stg_snapshot(tables),
    )
    return declared_test_results(staged.extended(**marts(staged)))


# --- counts and profiles --------------------------------------------------------------------------


@_query
def movement_type_histogram(tables):
    return P.movement_type_histogram(tables["inventory_movements"])


@_query
def profile_customers(tables):
    return P.profile_customers(tables["customers"])


@_query
def profile_products(tables):
    return P.profile_products(tables["products"])


@_query
def table_counts(tables):
    narrow = _keys_only(tables)
    return P.row_counts({name: narrow[name] for name in TABLES}, TABLES)


@_query
def positions_on_date(tables):
    return P.positions_on_date(tables["inventory"], _day())


# --- ledger and audits ------------------------------------------------------------------------------


@_query
def ledger(tables):
    narrow = _units_only(tables)
    return L.movement_ledger(
        narrow["purchase_order_items"],
        narrow["purchase_orders"],
        narrow["order_items"],
        narrow["orders"],
        narrow["returns"],
    )


@_query
def eligible_positions(tables):
    return L.eligible_positions(tables["inventory"], _day())


@_query
def order_pricing(tables):
    priced = R.priced_lines(tables["priced_lines"])
    return priced.groupBy("order_id").agg(
        F.sum("gross_amount").cast("decimal(18,2)").alias("gross_amount"),
        F.sum("discount").cast("decimal(18,2)").alias("discount"),
        F.sum("total_amount").cast("decimal(18,2)").alias("order_value"),
    )


@_query
def order_value_audit(tables):
    return R.order_value_deviations(tables["orders"], tables["line_values"])


@_query
def refund_audit(tables):
    return R.refund_deviations(tables["returns"], tables["order_items"])


@_query
def returnable_items(tables):
    return R.returnable_items(
        tables["order_heads"], tables["customers"], tables["order_items"], tables["products"], tables["categories"]
    )


@_query
def return_risk(tables):
    return R.return_risk(
        R.returnable(
            tables["order_heads"],
            tables["customers"],
            tables["sold_keys"],
            tables["products"],
            tables["categories"],
        )
    )


@_query
def stock_balance(tables):
    return R.stock_balance_deviations(tables["inventory"])


@_query
def missing_positions(tables):
    return R.missing_positions(tables["warehouses"], tables["products"], tables["inventory"], _day())


@_query
def shipment_consistency(tables):
    return R.shipment_consistency(tables["order_heads"], tables["shipments"])


@_query
def po_consistency(tables):
    return R.purchase_order_consistency(tables["purchase_orders"], tables["po_line_facts"])


@_query
def po_receipt_deviations(tables):
    return R.receipt_deviations(tables["purchase_orders"], tables["po_line_facts"])


@_query
def po_cost_band(tables):
    return R.cost_band_deviations(
        tables["purchase_order_items"], tables["purchase_orders"], tables["products"], tables["suppliers"]
    )


@_query
def supplier_tiers(tables):
    return R.supplier_tiers(tables["suppliers"])


@_query
def supplier_assortment(tables):
    return R.supplier_assortment(tables["suppliers"], tables["products"])


def _known_positions(tables: Relations) -> tuple[DataFrame, DataFrame]:
    """Positions known from movements, and those of the stock snapshots."""
    moved = (
        tables["inventory_movements"]
        .groupBy("warehouse_id", "product_id")
        .agg(F.min(F.to_date("movement_date")).alias("since"))
        .withColumn("origin", F.lit("ledger"))
    )
    stocked = tables["inventory"].select(
        "warehouse_id",
        "product_id",
        F.col("snapshot_date").alias("since"),
        F.lit("snapshot").alias("origin"),
    )
    return moved, stocked


@_query
def insert_if_absent(tables):
    """Positions known from movements, completed by those only the stock snapshots know."""
    return R.insert_if_absent(*_known_positions(tables), ["warehouse_id", "product_id"], ["since"])


@_query_with_session
def load_absent_twice(spark, root):
    """The same by loads into a target, the second of them run twice."""
    moved, stocked = _known_positions(conform.conformed(spark, root))
    target, keys = scratch_path(spark, "positions"), ["warehouse_id", "product_id"]
    load_absent(spark, target, "movements", moved, keys, ["since"])
    for _ in range(2):
        load_absent(spark, target, "snapshots", stocked, keys, ["since"])
    return loaded(spark, target, moved.schema)


# --- reading back what was written ---------------------------------------------------------------------


@_query_with_session
def parquet_roundtrip(spark, root):
    tables, location = conform.conformed(spark, root), scratch_path(spark, "movements")
    parts = W.Counted(tables["inventory_movements"]).parts(
        lambda rows: m1_movements_processed(tables.extended(inventory_movements=rows)), months(), stash=True
    )
    write_parts(parts, location, MOVEMENTS_PROCESSED.partition_by)
    return read_dataset(spark, location, MOVEMENTS_PROCESSED.schema).select(*MOVEMENTS_PROCESSED.columns)


@_query_with_session
def tsv_roundtrip(spark, root):
    location = scratch_path(spark, "landing")
    write_landing(_with_faults(conform.conformed(spark, root))["inventory_movements"], location)
    return read_landing(spark, location, TABLES["inventory_movements"])


def _staged(run: W.Run, tables: Relations) -> None:
    """Stages the three datasets and counts on the way from the sources to them."""
    stage_movements(run, W.Counted(tables["inventory_movements"]), _dims(tables), stash=True)
    stage_daily(run)
    stage_snapshot(run, W.Counted(tables["inventory"]), _dims(tables))


def _published(spark: SparkSession, root: str) -> Relations:
    """The three datasets; the metrics are made of the movements as staged, so those are made once."""
    tables = conform.conformed(spark, root)
    location = scratch_path(spark, "published")
    with W.Run(spark, location) as run:
        _staged(run, tables)
        run.commit()
    return published(spark, location)


@_query_with_session
def publish_roundtrip(spark, root):
    return _published(spark, root)["inventory_daily_metrics"]


@_query_with_session
def published_counts(spark, root):
    """Rows of the published datasets beside those of their source."""
    live = _published(spark, root)
    frames = {name: live[name] for name in CONTRACTS}
    frames["source_inventory_movements"] = conform.conformed(spark, root)["inventory_movements"]
    return P.row_counts(frames, frames)


def _counted_run(spark: SparkSession, tables: Relations) -> W.Run:
    """A run that counts on the way from the sources to what it published."""
    with W.Run(spark, scratch_path(spark, "counted")) as run:
        _staged(run, tables)
        run.commit()
    return run


@_query_with_session
def dq_published_counts(spark, root):
    """What the sources hold, what came out of the joins and what was published, and the difference."""
    run = _counted_run(spark, conform.conformed(spark, root))
    return W.count_differences(spark, commits.latest(spark, run.root))


@_query_with_session
def dq_published_counts_dirty(spark, root):
    """The same where one product is there twice under different names."""
    tables = conform.conformed(spark, root)
    products = tables["products"]
    first = products.filter(F.col("product_id") == products.agg(F.min("product_id")).scalar())
    doubled = products.unionByName(first.withColumn("product_name", F.concat("product_name", F.lit(" (again)"))))
    moves = W.Counted(tables["inventory_movements"])
    contract = replace(MOVEMENTS_PROCESSED, key=("movement_id", "product_name"))
    with W.Run(spark, scratch_path(spark, "doubled")) as run:
        stage_movements(run, moves, _dims(tables) | {"products": doubled}, contract, stash=True)
        commit = run.commit()
    return W.count_differences(spark, commit)


def _published_days(spark: SparkSession, root: str) -> str:
    """A folder in which the daily metrics are live."""
    tables, location = conform.conformed(spark, root), scratch_path(spark, "days")
    parts = W.Counted(tables["inventory_movements"]).parts(
        lambda rows: m2_daily_metrics(tables.extended(inventory_movements=rows)), months(), stash=True
    )
    publish(spark, {DAILY_METRICS.name: m2_daily_metrics(tables)}, location, parts={DAILY_METRICS.name: parts})
    return location


@_query_with_session
def dq_leftover_runs(spark, root):
    """Runs beside the live one: one whose writer has died, and one that is still being written."""
    location = _published_days(spark, root)
    days = published(spark, location)[DAILY_METRICS.name]
    now = time.time()
    for owner, expires in (("crashed", now - 1), ("other", now + 3600)):
        folder = f"{location}/runs/{owner}"
        storage.make_folder(spark, f"{location}/leases")
        commits.write_lease(spark, location, commits.Lease(owner, owner, folder, expires))
        write_dataset(days, f"{folder}/{DAILY_METRICS.name}")
    return W.run_states(spark, location, now)


@_query_with_session
def dq_changed_partitions(spark, root):
    """Partitions of live daily metrics to which rows were added behind the publisher's back."""
    location = _published_days(spark, root)
    entry = commits.latest(spark, location).datasets[DAILY_METRICS.name]
    month = f"{entry['root']}/movement_year=1996/movement_month=11"
    if storage.exists(spark, month):
        held = published(spark, location)[DAILY_METRICS.name].filter("movement_year = 1996 AND movement_month = 11")
        extra = stashed(held.filter("product_id % 2 = 0").drop("movement_year", "movement_month"), "extra")
        extra.write.mode("append").parquet(month)
    return W.changed_partitions(spark, location)


@_query_with_session
def partition_replace(spark, root):
    """Daily metrics after one month was published anew; the other months stay where they lie."""
    location = _published_days(spark, root)
    month = published(spark, location)[DAILY_METRICS.name].filter("movement_year = 1996 AND movement_month = 11")
    mended = month.withColumn("net_quantity", F.col("net_quantity") + 1000)
    if not month.isEmpty():
        publish(spark, {DAILY_METRICS.name: mended}, location, carry_over=True)
    return published(spark, location)[DAILY_METRICS.name]


@_query_with_session
def sql_views(spark, root):
    """Relations read through SQL by name: stock-outs by state, from the published view."""
    tables = conform.conformed(spark, root)
    named = tables.extended(stg_inventory_snapshot=I.staged_snapshot(m3_snapshot_enriched(tables)))
    named.publish_views(["stg_inventory_snapshot", "warehouses"])
    return spark.sql(
        """
        SELECT w.state, s.stock_status, count(*) AS positions, sum(s.available_stock) AS available_units
        FROM stg_inventory_snapshot s JOIN warehouses w ON w.warehouse_id = s.warehouse_id
        GROUP BY w.state, s.stock_status
        """
    )


@_query_with_session
def pipeline_report(spark, root):
    """The whole gated run over tables that were first written as Parquet."""
    tables = conform.conformed(spark, root)
    folder = scratch_path(spark, "pipeline")
    for name in TABLES:
        write_dataset(tables[name], f"{folder}/source/{name}")
    config = RunConfig(f"{folder}/processed", f"{folder}/published", AS_OF)
    return run_pipeline(spark, parquet_relations(spark, f"{folder}/source"), config)


def all_queries() -> dict[str, Query]:
    return dict(_queries)
