"""What small files grow to is spread over tasks and never held in the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows

from depotflow.operators import inventory as I
from depotflow.plans import checks, conform
from depotflow.verification import queries

ROOT = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_positions_are_not_broadcast_to_meet_warehouses(spark):
    """The file of products is smaller than that of nations and regions together, its positions are not."""
    plan = plan_of(conform.conformed(spark, ROOT)["inventory"])
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan


def test_positions_of_one_small_file_are_made_by_many_tasks(spark):
    made_by = conform.conformed(spark, ROOT)["inventory"].groupBy(F.spark_partition_id().alias("task")).count()
    counts = [row["count"] for row in made_by.collect()]
    assert len(counts) == 8 and max(counts) < 2 * min(counts)


def test_daily_metrics_aggregate_the_ledger_on_three_keys_only(spark):
    """The rows of the ledger meet one aggregation, in two halves; the others are of the dimensions."""
    tables = conform.conformed(spark, ROOT)
    plan = plan_of(I.daily_metrics_from_sources(tables["inventory_movements"], tables["products"], tables["warehouses"], tables["categories"]))
    assert plan.count("sum(inbound_quantity") == 0 and "keys=[warehouse_id" in plan


def test_daily_metrics_count_repeated_dimension_rows_as_often(spark):
    """Products, categories and warehouses that are there twice, with the same names or others."""
    tables = conform.conformed(spark, ROOT)
    moves = tables["inventory_movements"].filter("product_id < 40").unionByName(
        tables["inventory_movements"].limit(50).selectExpr("movement_id", "CAST(NULL AS BIGINT) AS warehouse_id", "-1L AS product_id", *tables["inventory_movements"].columns[3:])
    ).localCheckpoint()
    dims = []
    for name, other in (("products", "product_name"), ("warehouses", "warehouse_name"), ("categories", "category_name")):
        frame = tables[name]
        key = frame.columns[0]
        renamed = frame.filter(F.col(key) % 3 == 0).withColumn(other, F.lit("other"))
        dims.append(frame.unionByName(frame.filter(F.col(key) % 2 == 0)).unionByName(renamed).localCheckpoint())
    wanted = I.daily_metrics(I.enriched_movements(moves, *dims))
    found = I.daily_metrics_from_sources(moves, *dims)
    assert found.dtypes == wanted.dtypes
    assert rows(found) == rows(wanted) and found.count() > 100


def test_published_metrics_are_made_of_the_staged_movements(spark, monkeypatch):
    """Lines are numbered and met with orders for the movements alone, not for the metrics again."""
    staged = []
    stage = queries.W.Run.stage
    monkeypatch.setattr(queries.W.Run, "stage", lambda run, name, frame, *rest: staged.append((name, plan_of(frame))) or stage(run, name, frame, *rest))
    live = queries._published(spark, ROOT)
    plans = dict(staged)
    assert set(plans) == set(live.names()) and "lineitem" not in plans["inventory_daily_metrics"]
    assert "l_orderkey" in plans["inventory_movements_processed"] and "l_orderkey" not in plans["inventory_daily_metrics"]


def test_lines_are_numbered_in_one_shuffle(spark):
    """No grouping by all columns comes before the buckets, which are all that lines are dealt out by."""
    lineitem = spark.read.parquet(f"{ROOT}/lineitem.parquet")
    plan = plan_of(conform.numbered_lines(lineitem))
    assert plan.count("Exchange hashpartitioning(bucket") == 1 and plan.count("Exchange") == 1 and "Aggregate" not in plan


def test_faulty_copies_read_their_rows_once(spark):
    """Rows that are not chosen stay as they are, also where the choice is unknown; the copies cost no second pass."""
    frame = spark.read.parquet(f"{ROOT}/supplier.parquet").selectExpr("nullif(s_suppkey, 3) AS id", "s_name AS name")
    broken = conform.faulty_copies(frame, [("id", "-1"), ("name", "NULL")], F.col("id") % 2 == 0)
    assert plan_of(broken).count("Scan parquet") == 1
    wanted = []
    for key, name in (tuple(row) for row in frame.collect()):
        wanted.append((key, name))
        if key is not None and key % 2 == 0:
            wanted += [(-1, name), (key, None), (key, name)]
    assert rows(broken) == sorted(wanted, key=str) and broken.dtypes == frame.dtypes


def test_staged_metrics_aggregate_on_three_keys(spark):
    """Keys and declared tests of the metrics need no aggregation over descriptive columns."""
    for query in ("dq_staging_keys", "dq_declared_tests", "dq_reconcile"):
        plan = plan_of(queries.all_queries()[query](spark, ROOT))
        daily = [line for line in plan.splitlines() if "HashAggregate" in line and "warehouse_id" in line and "movement_date" in line]
        assert daily and not any("category_name" in line or "product_name" in line for line in daily)


def test_filters_on_movements_hold_names_and_not_the_terms_of_their_dates(spark):
    """Where they held them, the code of the scan for faulty rows was too long for the JVM to compile."""
    moves = conform.conformed(spark, ROOT)["inventory_movements"]
    _, faulty = checks.movement_probes(moves, F.lit("2010-01-01").cast("timestamp_ntz"))
    plan = faulty.offenders._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("make_dt_interval") <= plan.count("AS arrived") * 3 + 2
    assert not any("make_dt_interval" in line for line in plan.splitlines() if "Filter" in line)
