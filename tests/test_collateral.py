"""D07 on the collateral examples of FIXTURES.md §2 (the reference's unit
tests and its shipped three-row report)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tesoro.operators.collateral import collateral_report

D1, D2, D3 = dt.date(2026, 1, 2), dt.date(2026, 1, 5), dt.date(2026, 1, 6)


def run(spark, dates, exposure, pnl):
    days = spark.createDataFrame([("pb", d) for d in dates], "book string, report_date date")
    e = spark.createDataFrame([("pb", d, float(x)) for d, x in zip(dates, exposure)],
                              "book string, report_date date, exposure double")
    p = spark.createDataFrame([("pb", d, float(x)) for d, x in zip(dates, pnl)],
                              "book string, report_date date, pnl double")
    out = collateral_report(days, e, p, ["book"]).orderBy("report_date").collect()
    return out


def test_vm_keeps_sign(spark):
    r = run(spark, [D1, D2], [100000, 100000], [1000, -1000])
    assert r[0].initial_margin == -5000.0
    assert [x.variation_margin for x in r] == [1000.0, -1000.0]
    assert [x.collateral_required for x in r] == [-4000.0, -6000.0]


def test_no_recall_below_buffer_tomorrow(spark):
    r = run(spark, [D1, D2, D3], [1_000_000, 0, 4_000_000], [0, 0, 0])
    assert [x.collateral_posted for x in r] == [0.0, 550000.0, 550000.0]
    assert r[1].excess_deficit == 550000.0
    assert r[2].excess_deficit == 350000.0


def test_minimum_recall(spark):
    r = run(spark, [D1, D2, D3], [20_000_000, 19_980_000, 0], [0, 0, 0])
    assert r[1].excess_deficit == 501000.0
    assert r[1].collateral_posted == r[2].collateral_posted == 1_500_000.0


def test_shipped_report(spark):
    r = run(spark, [D1, D2, D3], [100000] * 3, [0] * 3)
    assert [x.collateral_posted for x in r] == [0.0, 510000.0, 510000.0]
    assert [x.excess_deficit for x in r] == [-5000.0, 505000.0, 505000.0]


def test_keys_are_independent(spark):
    days = spark.createDataFrame([(k, d) for k in ("a", "b") for d in (D1, D2, D3)],
                                 "book string, report_date date")
    e = spark.createDataFrame([("a", d, 100000.0) for d in (D1, D2, D3)] +
                              [("b", d, 1_000_000.0) for d in (D1, D2, D3)],
                              "book string, report_date date, exposure double")
    p = spark.createDataFrame([], "book string, report_date date, pnl double")
    out = {(r.book, r.report_date): r for r in collateral_report(days, e, p, ["book"]).collect()}
    assert out[("a", D2)].collateral_posted == 510000.0
    assert out[("b", D2)].collateral_posted == 550000.0


def test_blocks_change_nothing_and_long_series_stay_linear(spark):
    import time
    n = 100_000
    first = dt.date(1800, 1, 1)
    days = spark.range(n).select(F.lit("pb").alias("book"), F.date_add(F.lit(first), F.col("id").cast("int")).alias("report_date"), "id")
    need = (F.pmod(F.col("id") * 7919, F.lit(2003)) * 9000).cast("double")
    report = lambda d, **kw: collateral_report(d.select("book", "report_date"), d.select("book", "report_date", need.alias("exposure")),
                                               d.select("book", "report_date", F.lit(0.0).alias("pnl")), ["book"], **kw)
    short = days.where("id < 700")
    want = [tuple(r) for r in report(short, block=100_000).orderBy("report_date").collect()]
    for block in (1, 7, 256):
        assert [tuple(r) for r in report(short, block=block).orderBy("report_date").collect()] == want
    assert len({r[5] for r in want}) > 5
    began = time.time()
    assert report(days).agg(F.count("collateral_posted").alias("n")).first()["n"] == n
    assert time.time() - began < 60
