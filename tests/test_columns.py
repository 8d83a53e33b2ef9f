"""Boundaries of the column functions."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from depotflow.functions import columns as X


def one(spark, *columns, data=((1,),), schema="x int"):
    return [tuple(row) for row in spark.createDataFrame(list(data), schema).select(*columns).collect()]


def test_direction_and_sign(spark):
    kinds = ["PURCHASE_RECEIPT", "RETURN", "TRANSFER_IN", "SALE", "DAMAGE", "TRANSFER_OUT", "ADJUSTMENT", "OTHER", None]
    got = one(
        spark,
        X.movement_direction(F.col("kind")),
        X.signed_quantity(F.col("kind"), F.col("q")),
        data=[(kind, 4) for kind in kinds],
        schema="kind string, q int",
    )
    assert got == [("inbound", 4)] * 3 + [("outbound", -4)] * 3 + [("adjustment", 0)] * 3


def test_stock_status_bounds(spark):
    cases = [(0, 5), (-1, 5), (1, 5), (5, 5), (6, 5), (None, 5), (3, None), (0, None)]
    got = one(
        spark, X.stock_status(F.col("available"), F.col("point")), data=cases, schema="available int, point int"
    )
    assert [row[0] for row in got] == [
        "STOCK_OUT", "STOCK_OUT", "REORDER", "REORDER", "HEALTHY", "HEALTHY", "HEALTHY", "STOCK_OUT",
    ]


def test_ratio(spark):
    got = one(
        spark,
        X.safe_ratio(F.col("a"), F.col("b")),
        data=[(1, 3), (1, 0), (None, 2), (1, 8), (12345, 100000), (3, None)],
        schema="a bigint, b bigint",
    )
    assert [row[0] for row in got] == [0.3333, None, None, 0.125, 0.1235, None]


def test_money_rounds_half_up(spark):
    got = one(
        spark,
        X.money(F.col("m")),
        data=[(Decimal("0.005"),), (Decimal("1.0049"),), (Decimal("-0.005"),)],
        schema="m decimal(10,4)",
    )
    assert [row[0] for row in got] == [Decimal("0.01"), Decimal("1.00"), Decimal("-0.01")]


def test_elapsed_time_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        data = [(datetime(2024, 3, 9, 12), datetime(2024, 3, 11, 12, 0, 0, 500000)), (datetime(2024, 1, 2), datetime(2024, 1, 1))]
        got = one(
            spark,
            X.elapsed_seconds(F.col("a"), F.col("b")),
            data=data,
            schema="a timestamp_ntz, b timestamp_ntz",
        )
        assert [row[0] for row in got] == [Decimal("172800.500000"), Decimal("-86400.000000")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_mean_elapsed_days_tie(spark):
    # 33.925 days exactly: HALF_UP gives 33.93.
    frame = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 2, 3, 22, 12))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert frame.agg(X.mean_elapsed_days(F.col("a"), F.col("b"))).first()[0] == 33.93


def test_reference_parts(spark):
    got = one(
        spark,
        X.reference_part(F.col("r"), 2),
        X.reference_part(F.col("r"), 3),
        data=[("PO-12-34",), ("ADJ-IN-5",), ("PO-1",), (None,), ("PO-99999999999999999999-1",)],
        schema="r string",
    )
    assert got == [(12, 34), (None, 5), (1, None), (None, None), (None, 1)]


def test_reference_text_and_codes(spark):
    got = one(
        spark,
        X.reference_text("PO", F.col("n"), F.col("n")),
        X.padded_code("SKU-", F.col("n")),
        data=[(7,), (12345678,), (None,)],
        schema="n bigint",
    )
    assert got == [("PO-7-7", "SKU-000007"), ("PO-12345678-12345678", "SKU-12345678"), (None, None)]


def test_lookup_and_clamp(spark):
    got = one(
        spark,
        X.looked_up(F.col("k"), {"a": 1.5}, 1.0),
        X.clamped(F.col("v"), 0.0, 0.15),
        data=[("a", 0.2), ("b", -1.0), (None, None)],
        schema="k string, v double",
    )
    assert got == [(1.5, 0.15), (1.0, 0.0), (1.0, None)]


def test_iso_week_pairs_with_the_calendar_year(spark):
    frame = spark.createDataFrame([(datetime(2023, 1, 1),)], "t timestamp_ntz")
    assert tuple(frame.select(F.weekofyear("t"), F.year("t")).first()) == (52, 2023)
