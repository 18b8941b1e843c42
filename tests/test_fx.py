"""D03 / D04 / X05 on the FX cases of FIXTURES.md §4."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tesoro.operators import calendar as C
from tesoro.operators import fx as FX

D = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(12)]   # Thu 1 … Mon 12
TARGETS = ["USD", "EUR", "GBP"]


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def targets(spark):
    return spark.createDataFrame([(c,) for c in TARGETS], "currency string")


def hist(spark, sources, start=D[0], end=D[11]):
    norm = [FX.normalise_fx_frame(s, TARGETS) for s in sources]
    out = FX.fx_history(norm, targets(spark), "USD", start, end)
    return {(r.date, r.currency): (r.fx_to_usd, r.fx_quality_flag) for r in out.collect()}


def test_header_and_key_cleanup(spark):
    raw = frame(spark, [("2026-01-02", " eur ", "0.9", "raw"), ("2026-01-02", "JPY", "150", "raw")],
                " Date  string, CURRENCY string, fx_to_usd string, fx_quality_flag string")
    out = FX.normalise_fx_frame(raw, TARGETS).collect()
    assert [(r.date, r.currency, r.fx_to_usd) for r in out] == [(D[1], "EUR", 0.9)]


def test_bad_cells(spark):
    raw = frame(spark, [("x", "EUR", "0.9", "raw"), ("2026-01-02", "EUR", "abc", "??")],
                "date string, currency string, fx_to_usd string, fx_quality_flag string")
    out = FX.normalise_fx_frame(raw, TARGETS).collect()
    assert len(out) == 1 and out[0].fx_to_usd is None and out[0].fx_quality_flag == "raw"


def test_precedence(spark):
    cols = "date date, currency string, fx_to_usd double, fx_quality_flag string"
    db = frame(spark, [(D[1], "EUR", 0.1, "raw"), (D[2], "EUR", 0.1, "raw"), (D[3], "EUR", 0.1, "raw")], cols)
    csv = frame(spark, [(D[2], "EUR", 0.2, "raw"), (D[3], "EUR", 0.2, "raw")], cols)
    fetched = frame(spark, [(D[3], "EUR", 0.3, "raw")], cols)
    h = hist(spark, [db, csv, fetched])
    assert [h[(D[i], "EUR")][0] for i in (1, 2, 3)] == [0.1, 0.2, 0.3]


def test_weekend_and_leading_gap(spark):
    cols = "date date, currency string, fx_to_usd double"
    # D[2] = Sat 3rd, D[1] = Fri 2nd, D[4] = Mon 5th; EUR starts on day 3
    src = frame(spark, [(D[1], "GBP", 0.90), (D[4], "GBP", 0.92), (D[2], "EUR", 0.8)], cols)
    h = hist(spark, [src])
    assert h[(D[2], "GBP")] == (0.90, "filled") and h[(D[3], "GBP")] == (0.90, "filled")
    assert h[(D[4], "GBP")] == (0.92, "raw")
    assert h[(D[0], "EUR")] == (0.8, "filled") and h[(D[1], "EUR")] == (0.8, "filled")
    assert h[(D[0], "GBP")] == (0.90, "filled")


def test_base_currency_always_one(spark):
    src = frame(spark, [(D[1], "GBP", 0.9)], "date date, currency string, fx_to_usd double")
    h = hist(spark, [src])
    assert all(h[(d, "USD")] == (1.0, "raw") for d in D)


def test_currency_without_rates_fails_gate(spark):
    src = frame(spark, [(D[1], "GBP", 0.9)], "date date, currency string, fx_to_usd double")
    norm = [FX.normalise_fx_frame(src, TARGETS)]
    out = FX.fx_history(norm, targets(spark), "USD", D[0], D[11])
    eur = [r.fx_to_usd for r in out.filter("currency = 'EUR'").collect()]
    assert eur and all(v is None for v in eur)          # never borrows GBP (Trap2)
    cal = C.build_calendar(spark, D[0], D[11])
    with pytest.raises(RuntimeError, match="EUR="):
        FX.assert_no_missing(out, cal)


def test_null_refetch_is_gap_filled(spark):
    cols = "date date, currency string, fx_to_usd double, fx_quality_flag string"
    stored = frame(spark, [(D[1], "EUR", 0.90, "raw"), (D[2], "EUR", 0.91, "raw")], cols)
    fetched = frame(spark, [(D[2], "EUR", None, "raw")], cols)
    h = hist(spark, [stored, fetched])
    assert h[(D[2], "EUR")] == (0.90, "filled")          # literal Trap3 behaviour


def test_late_correction_and_gap_plan(spark):
    cols = "date date, currency string, fx_to_usd double, fx_quality_flag string"
    stored = frame(spark, [(D[i], c, 1.0 + i / 100, "raw") for i in range(9) for c in ("EUR", "GBP")]
                   + [(D[9], "EUR", 1.5, "filled")], cols)
    fetched = frame(spark, [(D[9], "EUR", 1.09, None)], cols)
    h = hist(spark, [stored, fetched], end=D[9])
    assert h[(D[9], "EUR")] == (1.09, "raw")
    cal = C.build_calendar(spark, D[0], D[11])
    plan = FX.gap_plan(FX.normalise_fx_frame(stored, TARGETS), targets(spark), cal, D[0], D[11]).first()
    assert plan.latest_date == D[9]
    assert plan.first_recent_filled == D[9]
    # USD is never stored here, so the first business day is missing for it
    assert plan.first_missing_business_day == D[0]
    assert plan.fetch_start == D[0]
