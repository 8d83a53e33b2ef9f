"""Every registered query against its SQL, and totals known beforehand."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry
from depotflow.verification.oracle import all_oracles
from depotflow.verification.queries import all_queries

ROOT = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture()
def connection():
    with compare.duck(ROOT) as duck:
        yield duck


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, ROOT), connection, ORACLES[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.entry(spark).count() == 50


def test_known_counts_of_faults(spark):
    root = "/root/testdata/sf0.001"
    found = {row["check"]: row["violations"] for row in QUERIES["movement_audit_dirty"](spark, root).collect()}
    assert found == {
        "empty movement table": 0,
        "movements with NULL required fields": 104,
        "invalid movement types": 85,
        "non-positive quantities": 86,
        "future movement timestamps": 92,
        "duplicate movement ids": 83,
        "orphan warehouses": 104,
        "orphan products": 118,
        "invalid purchase references": 201,
        "invalid sale references": 217,
        "invalid return references": 19,
        "unpaired transfers": 0,
        "invalid adjustment references": 0,
    }


def test_clean_ledger_has_no_faults(spark):
    root = "/root/testdata/sf0.001"
    for name in ("dq_referential", "dq_movements", "dq_purchase_refs", "dq_sale_refs", "dq_return_refs",
                 "dq_transfers", "dq_adjustments", "dq_declared_tests", "dq_table_contract", "dq_required_values"):
        assert QUERIES[name](spark, root).filter("violations <> 0").collect() == []


@pytest.mark.parametrize(("name", "count"), [("dq_table_contract_dirty", 67), ("dq_required_values_dirty", 87), ("dq_declared_tests_dirty", 28)])
def test_every_check_can_fire(spark, name, count):
    found = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == count and [row["check"] for row in found if row["violations"] == 0] == []
