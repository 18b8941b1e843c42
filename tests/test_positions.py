"""D02 / D11 / W12 / R-S1 / entry contract (FIXTURES.md §7, driver tables)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tesoro.functions import text as T
from tesoro.operators import intervals as I
from tesoro.operators import positions as P
from tests.conftest import SF_SMALL


def test_leg_never_on_value_date_and_delta_equals_expansion(spark):
    legs = spark.createDataFrame([
        ("b1", 1, dt.date(2026, 1, 2), dt.date(2026, 1, 6), Decimal("100.00")),
        ("b1", 2, dt.date(2026, 1, 3), dt.date(2026, 1, 9), Decimal("50.00")),
        ("b2", 3, dt.date(2026, 1, 5), dt.date(2026, 1, 6), Decimal("7.00"))],
        "bank_id string, trade_id int, trade_date date, value_date date, size decimal(18,2)")
    bd = spark.createDataFrame([(dt.date(2026, 1, d),) for d in (2, 5, 6, 7, 8, 9)], "report_date date")
    exp = I.expand_active(legs, bd, "trade_date", "value_date")
    assert exp.filter(F.col("report_date") == F.col("value_date")).count() == 0
    a = {(r.bank_id, r.report_date): r.s for r in exp.groupBy("bank_id", "report_date").agg(F.sum("size").alias("s")).collect()}
    b = {(r.bank_id, r.report_date): r.exposure
         for r in I.exposure_series(legs, bd, ["bank_id"], "trade_date", "value_date", "size").collect()}
    assert a == b
    assert b[("b1", dt.date(2026, 1, 5))] == Decimal("150.00")


def test_split_across_banks(spark):
    cap = spark.createDataFrame([("t1", "A", 70.0, 100), ("t1", "B", 20.0, 100), ("t1", "C", 30.0, 100),
                                 ("t2", "A", 70.0, 121), ("t2", "B", 20.0, 121), ("t2", "C", 30.0, 121)],
                                "trade_id string, bank_id string, remaining_usd double, need_usd int")
    got = {(r.trade_id, r.bank_id): float(r.allocated_usd) for r in P.split_across_banks(cap).collect()}
    assert got == {("t1", "A"): 70.0, ("t1", "C"): 30.0}


def test_daily_ids(spark):
    tr = spark.createDataFrame([(i, "spot" if i % 3 else "swap", dt.date(2026, 1, 2 + i % 2)) for i in range(40)],
                               "trade_id int, type string, trade_date date")
    code = T.code_map(F.col("type"), T.TRADE_TYPE_CODES)
    plain = {r.trade_id: r.seq for r in P.daily_sequence_id(tr, "trade_date", code, ["trade_id"], width=4, out_col="new_id").collect()}
    for step in (1, 3, 8, 64, 1000):    # slices never change a number
        sliced = P.daily_sequence_id(tr, "trade_date", code, ["trade_id"], width=4, out_col="new_id", step=step).collect()
        assert {r.trade_id: r.seq for r in sliced} == plain
    rows = P.daily_sequence_id(tr, "trade_date", code, ["trade_id"], width=4, step=4).collect()
    assert all(__import__("re").fullmatch(T.TRADE_ID_PATTERN, r.trade_id) for r in rows)
    assert len({r.trade_id for r in rows}) == 40
    per_day = {}
    for r in rows:
        per_day.setdefault(r.trade_date, []).append(r.seq)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_day.values())


def test_sequence_overflow_raises(spark):
    df = spark.range(10_000).selectExpr("id", "DATE '2026-01-02' AS d")
    ok = P.daily_sequence_id(df.filter("id < 9999"), "d", F.lit("SP"), ["id"], width=4, out_col="x")
    assert ok.agg(F.count_distinct("x")).first()[0] == 9_999
    for step in (None, 100):
        with pytest.raises(Exception, match="daily sequence overflow: 10000"):
            P.daily_sequence_id(df, "d", F.lit("SP"), ["id"], width=4, out_col="x", step=step).select("x").collect()


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 150
