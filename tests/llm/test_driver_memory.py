"""What the driver holds of a stage that is done is freed, and its plans stay small."""

from __future__ import annotations

import gc
import weakref

from depotflow.llm import common, linking, mixing

ROOT = "/root/testdata/sf0.001"


def test_each_feature_is_stated_once_in_the_plan(spark, monkeypatch):
    """A feature's expression is not repeated for each of its bounds."""
    plans = {}
    stash = mixing.stash

    def kept(frame, label):
        plans[label] = frame._jdf.queryExecution().optimizedPlan().toString()
        return stash(frame, label)

    monkeypatch.setattr(mixing, "stash", kept)
    docs, labels = (common.table(spark, ROOT, name) for name in ("documents", "labels"))
    mixing.domain_posteriors(docs, labels)[0].count()
    assert plans["mixing-features"].count("[A-Z]") <= 2


def test_broadcasts_behind_a_stashed_table_are_released(spark):
    """The plan of a stashed table can go, and the driver has collected its garbage by then."""
    collected = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    runs = lambda: sum(bean.getCollectionCount() for bean in collected() if "Old" in bean.getName() or "MarkSweep" in bean.getName())
    before = runs()
    frame = spark.range(10)
    gone = weakref.ref(frame)
    stashed = common.stash(frame, "numbers")
    del frame
    gc.collect()
    assert gone() is None and runs() > before and stashed.count() == 10


def test_plans_of_the_contraction_stay_small(spark, monkeypatch):
    """A round's plan reads its links a few times, not once for each use of each use; hot nodes or none."""
    scans = []
    stash = linking.stash

    def kept(frame, label):
        scans.append(frame._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return stash(frame, label)

    monkeypatch.setattr(linking, "stash", kept)
    chain = [(i, i + 1) for i in range(20)]
    star = [(1000, 1000 + i) for i in range(1, linking.COLD_LINKS + 50)]
    for links in (chain, chain + star):
        got = dict(linking.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
        assert got == {node: 1000 if node >= 1000 else 0 for link in links for node in link}
    assert max(scans) <= 6
