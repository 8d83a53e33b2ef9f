"""Loads that add what a target lacks, once each.

A target is a log of commits, one per load, that name the folders rows were added in. A load has an
id of its caller's choice: one that the log names is not done again. A load that died has left a
folder that no commit names, so nobody reads it, and can simply be repeated. Of two
loads at the same time one is committed; the other looks again at what is now missing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from depotflow.operators.audits import absent_rows
from depotflow.plans import commits
from depotflow.plans.commits import Commit, LostRace
from depotflow.sources import storage
from depotflow.sources.files import write_dataset

_ROWS = "rows"


def loaded(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of a target; empty before the first load."""
    commit = commits.latest(spark, root)
    folders = commit.datasets.get(_ROWS, {}).get("folders", []) if commit else []
    frames = [spark.read.schema(schema).parquet(folder) for folder in folders]
    return reduce(lambda left, right: left.unionByName(right), frames) if frames else spark.createDataFrame([], schema)


def load_absent(
    spark: SparkSession, root: str, load_id: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> int:
    """Adds the incoming rows whose key the target lacks; returns how many, none if done before.

    Of incoming rows that share a key the lowest by ``order`` is taken. Rows that are there stay as they are.
    """
    while True:
        log = commits.history(spark, root)
        if any(commit.run == load_id for commit in log):
            return 0
        folders = log[-1].datasets[_ROWS]["folders"] if log else []
        absent = absent_rows(loaded(spark, root, incoming.schema), incoming, keys, order)
        folder = f"{root}/loads/{uuid.uuid4().hex[:12]}"
        rows = write_dataset(absent, folder)
        kept = [*folders, folder] if rows else folders
        entry = {_ROWS: {"folders": kept}}
        try:
            commits.add_commit(spark, root, Commit(len(log) + 1, load_id, entry, [{"load": load_id, "rows": rows}]))
        except LostRace:
            storage.remove(spark, folder)
            continue
        if not rows:
            storage.remove(spark, folder)
        return rows
