"""Reading, writing, publishing and the gated run."""

from __future__ import annotations

import threading
import time
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from depotflow.model import CONTRACTS, PRIMARY_KEYS, TABLES
from depotflow.operators import inventory as I
from depotflow.operators import digests as D
from depotflow.operators import quality as Q
from depotflow.plans import commits, conform
from depotflow.plans import pipeline as L
from depotflow.plans import publish as W
from depotflow.session import scratch_path, shared_folder, stashed
from depotflow.sources import files, jdbc, storage
from depotflow.sources.relations import Relations, parquet_relations

ROOT = "/root/testdata/sf0.001"
AS_OF = datetime(2010, 1, 1)


@pytest.fixture(scope="module")
def frames(spark):
    tables = conform.conformed(spark, ROOT)
    dims = {name: tables[name] for name in ("products", "warehouses", "categories")}
    enriched = I.enriched_movements(tables["inventory_movements"], **dims)
    outputs = (enriched, I.daily_metrics(enriched), I.enriched_snapshot(tables["inventory"], **dims))
    return dict(zip(CONTRACTS, outputs))


def test_missing_dataset_is_refused(spark):
    with pytest.raises(RuntimeError, match="does not exist"):
        files.read_dataset(spark, scratch_path(spark, "nowhere"))


def test_partitioned_write_counts_and_prunes(spark, frames):
    location = scratch_path(spark, "test-daily")
    frame = frames["inventory_daily_metrics"]
    written = files.write_dataset(frame, location, ("movement_year", "movement_month"))
    back = files.read_dataset(spark, location)
    assert written == back.count() == frame.count()
    assert {f.name: f.dataType.simpleString() for f in back.schema}["movement_year"] == "int"
    plan = back.filter("movement_year = 1996")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(movement_year" in plan


def test_landing_files_keep_nulls_and_text(spark):
    location = scratch_path(spark, "test-landing")
    schema = TABLES["inventory_movements"]
    data = [
        (1, 1, 1, "SALE", 2, datetime(2024, 5, 6, 7, 8, 9, 10), None),
        (2, 1, 1, "SALE", 2, datetime(2024, 5, 6), ""),
        (3, 1, 1, "SALE", 2, datetime(2024, 5, 6), 'a "b" \\ c'),
    ]
    frame = spark.createDataFrame(data, schema)
    files.write_landing(frame, location)
    assert rows(files.read_landing(spark, location, schema)) == rows(frame)


def test_jdbc_options(spark):
    database = jdbc.Database("jdbc:somewhere", {"user": "u"})
    plain = jdbc.scan_options(database, "public.orders")
    assert plain["fetchsize"] == "10000" and plain["preferTimestampNTZ"] == "true" and "numPartitions" not in plain
    split = jdbc.scan_options(database, "public.orders", "order_id", (1, 900), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("order_id", "1", "900", "8")
    assert "partitionColumn" not in jdbc.scan_options(database, "t", "order_id", None, 8)
    assert jdbc.write_options(database, "t", 4)["batchsize"] == "10000"


def test_relations(spark):
    one = Relations({"a": lambda: spark.range(1)})
    assert one.missing(["a", "b"]) == ["b"]
    assert one["a"] is one["a"]
    assert one.extended(a=spark.range(2))["a"].count() == 2
    with pytest.raises(KeyError):
        one["b"]
    one.publish_views()
    assert spark.sql("SELECT count(*) FROM a").first()[0] == 1


def test_publish_switches_everything_or_nothing(spark, frames):
    root = scratch_path(spark, "test-publish")
    small = {name: frame.filter(F.col(CONTRACTS[name].partition_by[1]) == 11) for name, frame in frames.items()}
    first = W.publish(spark, small, root)
    live = W.live_run(spark, root)
    seen = {name: W.published(spark, root)[name].count() for name in CONTRACTS}
    assert seen == first and min(first.values()) > 0

    broken = dict(small)
    daily = small["inventory_daily_metrics"]
    broken["inventory_daily_metrics"] = daily.unionByName(daily)
    with pytest.raises(RuntimeError, match="duplicate key"):
        W.publish(spark, broken, root)
    assert W.live_run(spark, root) == live and W.leftover_runs(spark, root) == []
    assert storage.child_names(spark, f"{root}/runs") == [live] and storage.child_names(spark, f"{root}/leases") == []
    assert {name: W.published(spark, root)[name].count() for name in CONTRACTS} == seen

    empty = dict(small, inventory_daily_metrics=daily.filter("false"))
    with pytest.raises(RuntimeError, match="inventory_daily_metrics output is unexpectedly empty"):
        W.publish(spark, empty, root)

    W.publish(spark, small, root)
    assert W.live_run(spark, root) != live and W.leftover_runs(spark, root) == []
    with pytest.raises(RuntimeError, match="Nothing has been published"):
        W.published(spark, scratch_path(spark, "test-unpublished"))


def _days(frames, year=1996, month=None):
    frame = frames["inventory_daily_metrics"].filter(F.col("movement_year") == year)
    return {"inventory_daily_metrics": frame if month is None else frame.filter(F.col("movement_month") == month)}


def test_of_racing_publishers_one_wins(spark, frames):
    root = scratch_path(spark, "test-race")
    small = _days(frames, 1996, 11)
    W.publish(spark, small, root)
    outcome = []

    def race(start):
        try:
            with W.Run(spark, root) as run:
                run.stage("inventory_daily_metrics", small["inventory_daily_metrics"], CONTRACTS["inventory_daily_metrics"])
                start.wait()
                outcome.append(run.commit().run)
        except commits.LostRace as lost:
            outcome.append(lost)

    start = threading.Barrier(4)
    racers = [threading.Thread(target=race, args=(start,)) for _ in range(4)]
    for racer in racers:
        racer.start()
    for racer in racers:
        racer.join()
    winners = [o for o in outcome if isinstance(o, str)]
    assert len(winners) == 1 and len(outcome) == 4 and W.live_run(spark, root) == winners[0]
    assert [c.number for c in commits.history(spark, root)] == [1, 2]
    assert len(storage.child_names(spark, f"{root}/runs")) == 2 and commits.leases(spark, root) == []


def test_a_commit_is_created_once(spark):
    root = scratch_path(spark, "test-commit")
    commits.add_commit(spark, root, commits.Commit(1, "a"))
    with pytest.raises(commits.LostRace):
        commits.add_commit(spark, root, commits.Commit(1, "b"))
    assert commits.latest(spark, root).run == "a"
    assert storage.child_names(spark, f"{root}/manifests") == ["000000000001.json"]


def test_leftovers_are_runs_with_an_expired_lease(spark, frames):
    root = scratch_path(spark, "test-lease")
    W.publish(spark, _days(frames, 1996, 11), root)
    storage.make_folder(spark, f"{root}/runs/foreign")  # nobody's run: left alone
    run = W.Run(spark, root, owner="slow", lease_seconds=0.6)
    run.stage("days", frames["inventory_daily_metrics"].limit(3))
    time.sleep(1.5)  # the lease would have expired, but it is renewed
    assert W.leftover_runs(spark, root) == []
    W.require_no_leftovers(spark, root)
    run._lease.stop()  # as if the process had died
    time.sleep(0.8)
    assert W.leftover_runs(spark, root) == [run.name]
    with pytest.raises(RuntimeError, match=f"Leftover staging runs: {run.name}"):
        W.require_no_leftovers(spark, root)
    assert [tuple(r) for r in W.run_states(spark, root).collect()] == [("slow", "leftover", 3)]
    assert commits.remove_leftovers(spark, root) == [run.name]
    assert W.leftover_runs(spark, root) == [] and run.name not in storage.child_names(spark, f"{root}/runs")
    assert "foreign" in storage.child_names(spark, f"{root}/runs")


def test_a_month_is_replaced_and_the_others_stay(spark, frames):
    root = scratch_path(spark, "test-month")
    name = "inventory_daily_metrics"
    W.publish(spark, _days(frames), root)
    before = commits.latest(spark, root).datasets[name]
    files_of = {p["partition"]: storage.child_names(spark, f"{p['root']}/{p['partition']}") for p in before["parts"]}
    month = W.published(spark, root)[name].filter("movement_month = 11")
    others = rows(W.published(spark, root)[name].filter("movement_month <> 11"))
    for net in (1, 2, 3):  # the folder of the first run outlives the commits that are kept
        W.publish(spark, {name: month.withColumn("net_quantity", F.lit(net).cast("bigint"))}, root, carry_over=True)
        live = W.published(spark, root)[name]
        assert rows(live.filter("movement_month <> 11")) == others
        assert {r[0] for r in live.filter("movement_month = 11").select("net_quantity").collect()} == {net}
        month = live.filter("movement_month = 11")
    after = commits.latest(spark, root).datasets[name]
    for part in after["parts"]:
        if not part["partition"].endswith("=11"):
            assert part["root"] == before["root"]
            assert storage.child_names(spark, f"{part['root']}/{part['partition']}") == files_of[part["partition"]]
    assert W.changed_partitions(spark, root).collect() == []
    with pytest.raises(Q.QualityError, match="duplicate key"):  # across runs as well
        doubled = W.published(spark, root)[name].filter("movement_month = 10").withColumn("movement_month", F.lit(13))
        W.publish(spark, {name: doubled}, root, carry_over=True)


def test_a_changed_row_is_found_in_its_partition(spark, frames):
    root = scratch_path(spark, "test-digest")
    name = "inventory_daily_metrics"
    W.publish(spark, _days(frames), root)
    assert W.changed_partitions(spark, root).collect() == []
    folder = commits.latest(spark, root).datasets[name]["root"]
    month = f"{folder}/movement_year=1996/movement_month=5"
    held = spark.read.parquet(month)
    first = held.orderBy("warehouse_id", "product_id", "movement_date").limit(1).collect()
    key = "warehouse_id = {} AND product_id = {} AND movement_date = DATE '{}'".format(*(first[0][c] for c in ("warehouse_id", "product_id", "movement_date")))
    changed = held.withColumn("net_quantity", F.when(F.expr(key), F.col("net_quantity") + 1).otherwise(F.col("net_quantity")))
    kept = stashed(changed, "test-changed")
    storage.remove(spark, month)
    kept.write.parquet(month)
    found = W.changed_partitions(spark, root).collect()
    assert [r["partition"] for r in found] == ["movement_year=1996/movement_month=5"]
    assert found[0]["rows"] == found[0]["committed_rows"] == kept.count()


def test_digests_add_up_and_see_columns_and_missing_values(spark):
    frame = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (1, None, "b"), (1, None, "b")], "x int, y int, z string")
    whole = D.digest_of(frame.agg(*[c.alias(n) for n, c in D.digest_columns(frame.columns).items()]).first().asDict())
    parts = [D.digest_of(r.asDict()) for r in D.partition_digests(frame, ["z"], frame.columns).collect()]
    assert sum(parts, D.Digest()) == whole and whole.rows == 4
    swapped = frame.select(F.col("y").alias("x"), F.col("x").alias("y"), "z").limit(1)
    one = lambda f: D.digest_of(f.agg(*[c.alias(n) for n, c in D.digest_columns(f.columns).items()]).first().asDict())
    assert one(swapped) != one(frame.limit(1)) and one(frame.limit(1)) == one(frame.limit(1).select("z", "y", "x"))
    assert one(frame.filter("false")) == D.Digest()


def test_line_ids_depend_on_nothing_but_the_lines(spark):
    lineitem = spark.read.parquet(f"{ROOT}/lineitem.parquet")
    first = lineitem.filter("l_orderkey = 1").limit(1)
    wide = first.crossJoin(spark.range(2000)).withColumn("l_linenumber", F.col("id").cast("int")).drop("id")
    equal = first.crossJoin(spark.range(500)).drop("id")
    lines = lineitem.unionByName(wide).unionByName(equal)
    numbered = conform.numbered_lines(lines)
    key = [name for name in lines.columns if name in numbered.columns]
    assert rows(numbered.select(*key)) == rows(lines.select(*key))
    assert numbered.select("line_id").distinct().count() == lines.count()
    assert rows(conform.numbered_lines(lines.repartition(7)).select(*key, "line_id")) == rows(numbered.select(*key, "line_id"))
    assert numbered.agg(F.max("line_id")).first()[0] < 10**15


class _Session:
    """The parts of a session that name its shared folder."""

    class _Context:
        applicationId = "app-test"

        def __init__(self, master):
            self.master = master

    def __init__(self, master, **conf):
        self.sparkContext, self.conf = self._Context(master), conf


def test_shared_folder_comes_from_the_session():
    cluster = _Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/scratch/"})
    assert shared_folder(cluster) == "hdfs://shared/scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local)


@pytest.fixture(scope="module")
def written_tables(spark):
    tables = conform.conformed(spark, ROOT)
    root = scratch_path(spark, "test-tables")
    for name in TABLES:
        files.write_dataset(tables[name], f"{root}/{name}")
    return parquet_relations(spark, root)


def test_run_reports_every_step(spark, written_tables):
    folder = scratch_path(spark, "test-run")
    report = L.run_pipeline(spark, written_tables, L.RunConfig(f"{folder}/processed", f"{folder}/published", AS_OF))
    found = {(row["step"], row["item"]): row["value"] for row in report.collect()}
    assert found[("source gate", "inventory_movements")] == found[("process", "inventory_movements_processed")] == 11_142
    assert found[("publish", "inventory_daily_metrics")] == 10_818
    assert found[("publish", "fct_supplier_performance")] == 10 and report.count() == len(found)
    live = W.published(spark, f"{folder}/published")
    assert live["fct_supplier_performance"].count() == 10 and len(live.names()) == 6
    lineage = commits.latest(spark, f"{folder}/published").lineage
    assert [c["source"] for c in lineage] == [c["published"] for c in lineage] and lineage[0]["source"] == 11_142
    assert found[("tests", "tests passed")] == 28
    assert found[("analytical gate", "fct_supplier_performance")] == 10


def test_a_failing_test_of_a_mart_changes_nothing(spark, written_tables, monkeypatch):
    folder = scratch_path(spark, "test-mart")
    config = L.RunConfig(f"{folder}/processed", f"{folder}/published", AS_OF)
    L.run_pipeline(spark, written_tables, config)
    live, held = W.live_run(spark, config.published_root), storage.child_names(spark, config.processed_root)
    original = L.marts

    def doubled(relations):
        made = original(relations)
        return made | {"fct_supplier_performance": made["fct_supplier_performance"].unionByName(made["fct_supplier_performance"])}

    monkeypatch.setattr(L, "marts", doubled)
    with pytest.raises(L.PipelineError, match="step 'tests' failed: unique fct_supplier_performance.supplier_id: 10"):
        L.run_pipeline(spark, written_tables, config)
    assert W.live_run(spark, config.published_root) == live
    assert storage.child_names(spark, config.processed_root) == held == [live]
    monkeypatch.setattr(L, "marts", original)
    other = W.Run(spark, config.published_root, config.processed_root)  # in flight meanwhile: no matter
    L.run_pipeline(spark, written_tables, config)
    assert W.live_run(spark, config.published_root) not in (live, other.name)
    other.__exit__(None, None, None)


def test_run_stops_at_the_first_failing_gate(spark, written_tables):
    folder = scratch_path(spark, "test-stop")
    config = L.RunConfig(f"{folder}/processed", f"{folder}/published", AS_OF)
    dirty = conform.corrupted_movements(written_tables["inventory_movements"])
    with pytest.raises(L.PipelineError, match="data-quality gate.*duplicate movement ids: 83"):
        L.run_pipeline(spark, written_tables.extended(inventory_movements=dirty), config)
    assert not storage.exists(spark, folder)
    empty = written_tables.extended(returns=written_tables["returns"].filter("false"))
    with pytest.raises(L.PipelineError, match="source gate.*without rows: returns"):
        L.run_pipeline(spark, empty, config)
    partial = Relations({name: (lambda n=name: written_tables[n]) for name in TABLES if name != "orders"})
    with pytest.raises(L.PipelineError, match="lacks tables: orders"):
        L.run_pipeline(spark, partial, config)


def test_movement_gate_can_stop_at_the_first_faulty_row(spark, written_tables):
    folder = scratch_path(spark, "test-first")
    config = L.RunConfig(f"{folder}/processed", f"{folder}/published", AS_OF, stop_at_first=True)
    moves = written_tables["inventory_movements"]
    twice = moves.unionByName(moves.orderBy("movement_id").limit(1))
    for dirty, fault in ((conform.corrupted_movements(moves), ".*: movement_id="), (twice, "duplicate movement ids: movement_id=")):
        with pytest.raises(L.PipelineError, match=f"data-quality gate' failed: {fault}"):
            L.run_pipeline(spark, written_tables.extended(inventory_movements=dirty), config)
    assert not storage.exists(spark, folder)


def test_model_is_complete():
    from depotflow.model import REFERENCES, UNIQUE_KEYS, VALUE_RULES

    assert len(TABLES) == len(PRIMARY_KEYS) == 13
    assert len(UNIQUE_KEYS) == 3 and len(REFERENCES) == 19
    assert sum(len(rules) for rules in VALUE_RULES.values()) == 32
    assert all(PRIMARY_KEYS[name] in schema.names for name, schema in TABLES.items())
    assert date(2001, 12, 31).isoformat() in conform.SNAPSHOT_DATES
