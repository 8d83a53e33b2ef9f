"""Probes that stop at the first hit, and scan ranges cut at quantiles."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from depotflow.operators import probes
from depotflow.operators.quality import QualityError
from depotflow.sources import jdbc, ranges


def never(check, cost, spark):
    """A probe that fails the job if it is ever run."""
    rows = spark.range(1).select(F.raise_error(F.lit(f"{check} ran")).cast("string").alias("fault"), F.lit("").alias("offender"))
    return probes.Probe(check, cost, rows)


@pytest.fixture(scope="module")
def parents(spark):
    return spark.createDataFrame([(1,), (2,)], "pid int")


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(10, 1, "a"), (11, 2, "b"), (11, 2, None), (12, 9, "c"), (13, 9, "d")], "id int, pid int, v string")


def test_later_probes_do_not_run(spark, child):
    hit = probes.faulty_rows("rows", child, {"bad": F.col("v") == "z", "no v": F.col("v").isNull()}, ["id", "v"])
    clean = probes.faulty_rows("more rows", child, {"bad": F.col("v") == "z"}, ["id"])
    asked = [never("join", probes.JOIN, spark), never("group", probes.GROUP, spark), clean, hit, never("scan", probes.SCAN, spark)]
    assert probes.probed(asked) == [
        probes.Outcome("more rows", probes.CLEAN),
        probes.Outcome("rows", probes.HIT, "no v", "id=11, v=NULL"),
        probes.Outcome("scan", probes.NOT_RUN),
        probes.Outcome("group", probes.NOT_RUN),
        probes.Outcome("join", probes.NOT_RUN),
    ]
    with pytest.raises(QualityError, match="no v: id=11, v=NULL"):
        probes.require_none(asked)
    with pytest.raises(Exception, match="group ran"):
        probes.probed([never("group", probes.GROUP, spark)])


def test_keys_and_references(spark, child, parents):
    twice = probes.repeated_keys("twice", child, ["id"])
    lost = probes.orphans("lost", child, "pid", parents, "pid", "id")
    assert probes.probed([lost, twice])[0] == probes.Outcome("twice", probes.HIT, "twice", "id=11")
    assert probes.probed([lost])[0].offender == "id=12, pid=9"
    assert probes.probed([probes.orphans("lost", child, "pid", parents, "pid")])[0].offender == "pid=9"
    unknown = child.withColumn("pid", F.lit(None).cast("int")).filter("id = 10")
    assert probes.probed([probes.orphans("lost", unknown, "pid", parents, "pid", "id")])[0].offender == "id=10, pid=NULL"
    assert probes.probed([probes.orphans("own key", child, "pid", parents, "pid", "pid")])[0].offender == "pid=9"
    for frame in (child.filter("false"), child.filter("id = 10")):
        asked = [probes.repeated_keys("twice", frame, ["id"]), probes.orphans("lost", frame, "pid", parents, "pid", "id")]
        assert {outcome.state for outcome in probes.require_none(asked)} == {probes.CLEAN}


def test_a_scan_ends_at_the_first_hit(child):
    plan = probes.faulty_rows("rows", child, {"bad": F.col("v") == "c"}, ["id"]).offenders.limit(1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit 1" in text and "Exchange" not in text


def depths(frame, key, bounds):
    return {row["range_no"]: row for row in ranges.range_depths(frame, key, bounds).collect()}


def test_ranges_of_equal_depth(spark):
    crowded = spark.range(10_000).select(F.when(F.col("id") < 9_900, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("k"))
    bounds = ranges.key_quantiles(crowded, "k", 8, fraction=0.5)
    assert len(bounds) == 7 and bounds == sorted(bounds)
    found = depths(crowded, "k", bounds)
    assert sum(row["rows"] for row in found.values()) == sum(row["met_once"] for row in found.values()) == 10_000
    assert max(row["rows"] for row in found.values()) < 1.3 * 10_000 / 8
    conditions = ranges.range_predicates("k", bounds)
    assert [crowded.filter(condition).count() for condition in conditions] == [found[i]["rows"] for i in range(8)]


def test_hot_missing_and_few_keys(spark):
    hot = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"))
    bounds = ranges.key_quantiles(hot, "k", 10)
    assert len(set(bounds)) == len(bounds) and 7 in bounds
    found = depths(hot, "k", bounds)
    assert sum(row["met_once"] for row in found.values()) == 3_000
    assert max(row["rows"] - row["hottest"] for row in found.values()) <= 2 * 300
    empty = hot.filter("false")
    assert ranges.key_quantiles(empty, "k", 10) == [] and ranges.range_predicates("k", []) == ["1 = 1"]
    assert ranges.key_quantiles(hot, "k", 1) == []
    assert ranges.key_quantiles(hot.filter("k = 7"), "k", 4) == [7]


def test_literals_and_the_sample_query():
    assert ranges.range_predicates("d", [date(2020, 1, 2), date(2021, 1, 1)]) == [
        "d < DATE '2020-01-02' OR d IS NULL", "d >= DATE '2020-01-02' AND d < DATE '2021-01-01'", "d >= DATE '2021-01-01'",
    ]
    assert ranges.range_predicates("t", [datetime(2020, 1, 2, 3)])[1] == "t >= TIMESTAMP '2020-01-02 03:00:00'"
    query = jdbc.sampled_keys("public.orders", "order_id", 1.0)
    assert query == "(SELECT order_id FROM public.orders TABLESAMPLE SYSTEM (1.0) REPEATABLE (17)) sampled_keys"
    with pytest.raises(ValueError, match="percent"):
        jdbc.sampled_keys("t", "k", 0)
