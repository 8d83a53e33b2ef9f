"""What lies on disk at a time: datasets are written in parts, and shuffle files go when their job is done."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows

from depotflow.model import DAILY_METRICS, MOVEMENTS_PROCESSED, SNAPSHOT_ENRICHED, TABLES
from depotflow.operators import probes
from depotflow.operators import quality as Q
from depotflow.plans import checks, conform, pipeline
from depotflow.plans import publish as W
from depotflow.session import scratch_path, shared_folder
from depotflow.sources import files, storage
from depotflow.verification import queries

ROOT = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in held.apply(i).getName() for i in range(held.size()))


def grouped(spark, number: int):
    counted = spark.range(1000).groupBy((F.col("id") % (7 + number)).alias("g")).count()
    return counted.select(F.lit(f"check {number}").alias("check"), "count").groupBy("check").agg(F.sum("count").alias("violations"))


def released(spark, before: int, one: int) -> bool:
    """Files of at most the last two queries are left of many."""
    return shuffle_files(spark) - before <= 2 * one


def test_shuffle_files_of_earlier_checks_are_gone(spark):
    frames = [grouped(spark, number) for number in range(8)]
    one = Q.one_by_one(frames[:1])
    before = shuffle_files(spark)
    found = Q.one_by_one(frames)
    assert released(spark, before, 16) and rows(found) == [(f"check {n}", 1000) for n in range(8)] and one.count() == 1


def test_shuffle_files_of_earlier_probes_are_gone(spark):
    asked = [probes.repeated_keys(f"probe {n}", spark.range(1000 + n), ["id"]) for n in range(12)]
    before = shuffle_files(spark)
    assert {outcome.state for outcome in probes.probed(asked)} == {probes.CLEAN}
    assert released(spark, before, 16)


def test_shuffle_files_of_a_write_are_gone(spark):
    before = shuffle_files(spark)
    frames = [spark.range(1000).select("id", (F.col("id") % 5).alias("part")) for _ in range(8)]
    seen = files.write_parts(frames, location := scratch_path(spark, "eight"), ["part"])
    assert released(spark, before, 16)
    assert [part["rows"] for part in seen] == [1000] * 8 and files.read_dataset(spark, location).count() == 8000


@pytest.mark.parametrize("stash", [False, True])
def test_parts_have_each_row_once(spark, stash):
    """Rows that are there twice, and keys that are missing, among them."""
    source = spark.createDataFrame([(n if n % 7 else None, n % 5) for n in range(60)] * 2, "id int, v int")
    counted, made = W.Counted(source), []
    before = set(storage.child_names(spark, f"{shared_folder(spark)}/depotflow"))
    found = [rows(part) for part in counted.parts(lambda part: made.append(part) or part.withColumn("w", F.col("v") + 1), ["id"], stash)]
    assert len(found) == W.PARTS == len(made) and all(found)
    assert sorted([row for part in found for row in part], key=str) == rows(source.withColumn("w", F.col("v") + 1))
    assert counted.found(120) == 120
    assert set(storage.child_names(spark, f"{shared_folder(spark)}/depotflow")) == before


def test_sources_of_few_rows_are_counted(spark):
    """Spark drops a join, and the counting below it, where a part has no rows."""
    tables = conform.conformed(spark, ROOT)
    few = {name: tables[name].limit(1).localCheckpoint() for name in ("inventory", "inventory_movements")}
    with W.Run(spark, scratch_path(spark, "few")) as run:
        pipeline.stage_movements(run, W.Counted(few["inventory_movements"]), queries._dims(tables))
        pipeline.stage_daily(run)
        pipeline.stage_snapshot(run, W.Counted(few["inventory"]), queries._dims(tables))
        run.require_counts()
        assert [(c["source"], c["processed"], c["published"]) for c in run.lineage] == [(1, 1, 1)] * 3


def parts_staged(monkeypatch, run_query) -> dict[str, int]:
    """How many frames each dataset is written in."""
    written, write = {}, files.write_observed

    def watched(frame, location, *rest, **more):
        name = location.rsplit("/", 1)[1]
        written[name] = written.get(name, 0) + 1
        return write(frame, location, *rest, **more)

    monkeypatch.setattr(files, "write_observed", watched)
    run_query()
    return written


@pytest.mark.parametrize("query", ["publish_roundtrip", "published_counts", "dq_published_counts", "pipeline_report"])
def test_large_datasets_are_written_in_parts(spark, monkeypatch, query):
    written = parts_staged(monkeypatch, lambda: queries.all_queries()[query](spark, ROOT))
    for contract in (MOVEMENTS_PROCESSED, DAILY_METRICS, SNAPSHOT_ENRICHED):
        assert written[contract.name] == W.PARTS


@pytest.mark.parametrize("query", ["dq_leftover_runs", "partition_replace"])
def test_published_days_are_written_in_parts(spark, monkeypatch, query):
    written = parts_staged(monkeypatch, lambda: queries.all_queries()[query](spark, ROOT))
    assert written[DAILY_METRICS.name] >= W.PARTS


def test_movements_are_written_in_parts(spark, monkeypatch):
    """Also where a product is there twice, and where they are only read back."""
    written = parts_staged(monkeypatch, lambda: queries.all_queries()["dq_published_counts_dirty"](spark, ROOT))
    assert written[MOVEMENTS_PROCESSED.name] == W.PARTS
    again = parts_staged(monkeypatch, lambda: queries.all_queries()["parquet_roundtrip"](spark, ROOT))
    assert max(again.values()) == W.PARTS


def test_contract_rules_run_by_few_tables_at_a_time(spark, monkeypatch):
    """No pass holds the keys of all tables, and no rule is left out or run twice."""
    passes, compiled = [], checks.compiled
    monkeypatch.setattr(checks, "compiled", lambda frames, rules: passes.append([r.label for r in rules]) or compiled(frames, rules))
    found = checks.table_contract(conform.conformed(spark, ROOT))
    labels = [label for some in passes for label in some]
    assert len(passes) > 3 and max(map(len, passes)) < 35
    assert len(labels) == len(set(labels)) == 67 and {row["check"] for row in found.collect()} == set(labels)
    assert sorted(name for some in checks._RULED_TOGETHER for name in some) == sorted(TABLES)


def test_audited_movements_are_made_once(spark, monkeypatch):
    made, stashed = [], checks.stashed
    monkeypatch.setattr(checks, "stashed", lambda frame, label: made.append(label) or stashed(frame, label))
    tables = queries._with_faults(queries._units_only(conform.conformed(spark, ROOT)))
    found = checks.movement_audit(tables, F.lit("2010-01-01").cast("timestamp_ntz"))
    assert len(made) == 1 and found.count() == 13
