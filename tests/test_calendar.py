"""D01 / J09 on the calendar facts of FIXTURES.md §5."""

import datetime as dt

from pyspark.sql import functions as F

from tesoro.operators import calendar as C

HOLIDAYS_2026 = ["2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19",
                 "2026-07-03", "2026-09-07", "2026-10-12", "2026-11-11", "2026-11-26",
                 "2026-12-25"]


def cal(spark, start="2026-01-01", end="2027-01-10"):
    hol = spark.createDataFrame([(d,) for d in HOLIDAYS_2026], "holiday_date string")
    return C.build_calendar(spark, start, end, hol)


def test_iso_edge(spark):
    c = {r.calendar_date: r for r in cal(spark).collect()}
    r = c[dt.date(2027, 1, 1)]
    assert (r.day_name, r.iso_week, r.iso_year, r.week_num) == ("Friday", 53, 2026, 53)
    assert c[dt.date(2027, 1, 4)].iso_week == 1
    assert c[dt.date(2026, 1, 31)].is_month_end and c[dt.date(2026, 2, 1)].is_month_start
    assert c[dt.date(2026, 1, 3)].is_weekend and c[dt.date(2026, 1, 3)].weekday == 5
    assert c[dt.date(2026, 1, 5)].day_of_week == 1 and c[dt.date(2026, 1, 5)].year_quarter == "2026-Q1"


def test_business_days(spark):
    c = cal(spark)
    n = c.filter((F.col("calendar_date") <= "2026-08-05") & F.col("is_business_day")).count()
    assert n == 149
    first = c.filter("is_business_day").agg(F.min("calendar_date")).first()[0]
    assert first == dt.date(2026, 1, 2)


def test_roll_and_clamp(spark):
    c = cal(spark)
    x = spark.createDataFrame([("2026-01-01",), ("2026-07-01",), ("2031-05-05",)], "d string") \
        .select(F.col("d").cast("date").alias("d"))
    got = {r.d: r.rolled_date for r in C.roll_to_business_day(x, "d", c).collect()}
    assert got[dt.date(2026, 1, 1)] == dt.date(2026, 1, 2)
    assert got[dt.date(2026, 7, 1)] == dt.date(2026, 7, 1)
    assert got[dt.date(2031, 5, 5)] == dt.date(2027, 1, 8)


def test_add_months_clamps(spark):
    r = spark.sql("SELECT add_months(date'2026-08-31', 6) AS d").first()
    assert r.d == dt.date(2027, 2, 28)


def test_workday_index_and_label(spark):
    c = C.latest_date_label(C.workday_index(cal(spark, "2026-01-01", "2026-01-12")))
    rows = {r.calendar_date: r for r in c.collect()}
    assert rows[dt.date(2026, 1, 3)].workday_index is None
    assert rows[dt.date(2026, 1, 5)].workday_index == 3
    assert rows[dt.date(2026, 1, 12)].date_label == "Latest Date"
    assert rows[dt.date(2026, 1, 2)].date_label == "02-Jan-2026"


def test_one_bad_date_does_not_bound_the_calendar(spark):
    df = spark.createDataFrame([(1, dt.date(2026, 1, 2)), (2, dt.date(9999, 12, 31)), (3, dt.date(2026, 3, 1)), (4, None)], "id int, d date")
    assert C.date_bounds(df, "d") == (dt.date(2026, 1, 2), dt.date(2026, 3, 1))
    assert [r.id for r in C.implausible_dates(df, "d").collect()] == [2]
