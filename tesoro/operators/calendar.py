"""Calendar dimension (D01), business-day roll (J09), workday index (W11),
latest-date label (P12).

The calendar is a *dimension*: its size is fixed by the requested date span,
never by the fact volume.  Dates outside ``PLAUSIBLE`` (a year typed as 9999)
never bound a calendar; they are rejects (``implausible_dates``) and match no
calendar day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesoro.functions import dates as D

# A calendar longer than this is almost certainly a bad bound (e.g. a date
# parsed as year 9999); refusing it keeps every broadcast of the calendar small.
MAX_CALENDAR_DAYS = 200 * 366

CALENDAR_COLUMNS = [
    "calendar_date", "year", "quarter", "month", "month_name", "day",
    "day_of_week", "day_name", "weekday", "is_weekend", "is_month_start",
    "is_month_end", "week_num", "year_month", "year_quarter", "iso_week",
    "iso_year",
]


def _as_date(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


# Dates that may bound a calendar.
PLAUSIBLE = (dt.date(1900, 1, 1), dt.date(2099, 12, 31))


def _plausible(c: str) -> Column:
    return F.col(c).cast("date").between(*(F.lit(d) for d in PLAUSIBLE))


def implausible_dates(df: DataFrame, *cols: str) -> DataFrame:
    """The rejects: rows with a date that no calendar will cover."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | ~F.coalesce(_plausible(c), F.lit(True))
    return df.filter(bad)


def date_bounds(df: DataFrame, *cols: str) -> tuple[dt.date, dt.date]:
    """(min, max) over the plausible dates of one or more columns: a single
    scalar row."""
    aggs = []
    for c in cols:
        d = F.when(_plausible(c), F.col(c).cast("date"))
        aggs += [F.min(d), F.max(d)]
    row = df.agg(*aggs).first()
    lows = [v for v in row[0::2] if v is not None]
    highs = [v for v in row[1::2] if v is not None]
    if not lows:
        raise ValueError("no dates to bound the calendar")
    return min(lows), max(highs)


def date_spine(spark: SparkSession, start, end, col: str = "calendar_date") -> DataFrame:
    """One row per day in [start, end] (D-S8), generated in parallel."""
    start, end = _as_date(start), _as_date(end)
    n = (end - start).days + 1
    if n <= 0:
        raise ValueError(f"empty calendar {start}..{end}")
    if n > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {n} days exceeds {MAX_CALENDAR_DAYS}")
    parts = max(1, min(64, n // 20000 + 1))
    return (spark.range(0, n, 1, parts)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(col)))


def calendar_columns(d: Column | str = "calendar_date") -> list[Column]:
    """The 17 columns of the date table, derived from one date column."""
    d = F.col(d) if isinstance(d, str) else d
    parts = D.date_parts(d)
    return [
        d.alias("calendar_date"),
        parts["year"].alias("year"),
        parts["quarter"].alias("quarter"),
        parts["month"].alias("month"),
        D.month_name(d).alias("month_name"),
        parts["day"].alias("day"),
        D.iso_day_of_week(d).alias("day_of_week"),
        D.day_name(d).alias("day_name"),
        D.weekday0(d).alias("weekday"),
        D.is_weekend(d).alias("is_weekend"),
        D.is_month_start(d).alias("is_month_start"),
        D.is_month_end(d).alias("is_month_end"),
        D.iso_week(d).alias("week_num"),
        D.year_month(d).alias("year_month"),
        D.year_quarter(d).alias("year_quarter"),
        D.iso_week(d).alias("iso_week"),
        D.iso_year(d).cast("int").alias("iso_year"),
    ]


def build_calendar(spark: SparkSession, start, end, holidays: DataFrame | None = None,
                   holiday_col: str = "holiday_date") -> DataFrame:
    """Date dimension with business-day columns.

    ``is_business_day`` = Monday–Friday and not in ``holidays`` (Trap4: pass
    no holidays for the plain Mon–Fri notion).  ``next_bd`` is the day itself
    if it is a business day, else the next one, clamped to the last business
    day of the calendar (Trap16); ``prev_bd`` is the mirror image.
    """
    spine = date_spine(spark, start, end)
    cal = spine.select(*calendar_columns("calendar_date"))
    if holidays is not None:
        hol = (holidays.select(F.col(holiday_col).cast("date").alias("calendar_date"))
               .distinct().withColumn("_hol", F.lit(True)))
        cal = cal.join(hol, "calendar_date", "left")
        is_bd = (~F.col("is_weekend")) & F.col("_hol").isNull()
    else:
        is_bd = ~F.col("is_weekend")
    cal = cal.withColumn("is_business_day", is_bd)
    # The calendar is bounded (asserted above), so an un-partitioned window
    # over it is a small single-task sort, not a fact-sized one.
    fwd = Window.orderBy("calendar_date").rowsBetween(0, Window.unboundedFollowing)
    back = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    bd = F.when(F.col("is_business_day"), F.col("calendar_date"))
    cal = (cal
           .withColumn("next_bd", F.coalesce(F.min(bd).over(fwd), F.max(bd).over(whole)))
           .withColumn("prev_bd", F.coalesce(F.max(bd).over(back), F.min(bd).over(whole))))
    return cal.select(*CALENDAR_COLUMNS, "is_business_day", "next_bd", "prev_bd")


def business_days(calendar: DataFrame, col: str = "report_date") -> DataFrame:
    return (calendar.filter(F.col("is_business_day"))
            .select(F.col("calendar_date").alias(col)))


def roll_to_business_day(df: DataFrame, date_col: str, calendar: DataFrame,
                         out_col: str = "rolled_date") -> DataFrame:
    """Each date → itself or the next business day (clamped at the end).

    Implemented as an equi join on the precomputed ``next_bd`` column of the
    broadcast calendar, so it is a hash lookup instead of an as-of search.
    Dates beyond the calendar clamp to its last business day.
    """
    lookup = calendar.select(F.col("calendar_date").alias("_d"), F.col("next_bd").alias(out_col))
    # Scalar subquery (one value), so no fact-sized cross join is planned.
    last_bd = calendar.agg(F.max(F.when(F.col("is_business_day"), F.col("calendar_date")))).scalar()
    out = df.join(lookup, F.col(date_col) == F.col("_d"), "left").drop("_d")
    return out.withColumn(
        out_col, F.when(F.col(date_col) > last_bd, last_bd).otherwise(F.col(out_col)))


def workday_index(calendar: DataFrame, out_col: str = "workday_index") -> DataFrame:
    """Running count of Mon–Fri days, NULL at weekends."""
    w = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    wk = (F.col("weekday") < 5).cast("int")
    return calendar.withColumn(out_col, F.when(F.col("weekday") < 5, F.sum(wk).over(w)))


def latest_date_label(calendar: DataFrame, date_col: str = "calendar_date",
                      out_col: str = "date_label", latest_text: str = "Latest Date") -> DataFrame:
    """P12: "Latest Date" on the maximum date, else DD-MMM-YYYY."""
    mx = F.max(F.col(date_col)).over(Window.partitionBy())
    return calendar.withColumn(
        out_col, F.when(F.col(date_col) == mx, F.lit(latest_text))
        .otherwise(D.dd_mmm_yyyy(date_col)))
