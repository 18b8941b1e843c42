"""Calendar scalar functions (D-S1 … D-S9).  All return Columns built from
Spark built-ins so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# D-S1 date_parts
def date_parts(d) -> dict[str, Column]:
    d = _c(d)
    return {"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
            "day": F.dayofmonth(d)}


# D-S2 date_names
def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


# D-S3 weekday_numbers: Monday-first.  Spark's dayofweek is Sunday=1, so it
# is deliberately not used.
def weekday0(d) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(_c(d))


def iso_day_of_week(d) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(_c(d)) + 1


# D-S4 iso_week_year
def iso_week(d) -> Column:
    return F.weekofyear(_c(d))


def iso_year(d) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _c(d))


# D-S5 date_flags
def is_weekend(d) -> Column:
    return F.weekday(_c(d)) >= 5


def is_month_start(d) -> Column:
    return F.dayofmonth(_c(d)) == 1


def is_month_end(d) -> Column:
    d = _c(d)
    return d == F.last_day(d)


# D-S6 period_labels
def year_month(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def year_quarter(d) -> Column:
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


# D-S7 date_arithmetic (add_months clamps to month end, like the reference)
def add_days(d, n) -> Column:
    return F.date_add(_c(d), n if isinstance(n, Column) else F.lit(n))


def add_months(d, n) -> Column:
    return F.add_months(_c(d), n if isinstance(n, Column) else F.lit(n))


# D-S8 date_sequence
def day_sequence(start, end) -> Column:
    """Array of every day in [start, end] (empty when end < start)."""
    start, end = _c(start), _c(end)
    return F.when(end >= start, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>"))


def month_step_sequence(start, end, months: int) -> Column:
    return F.sequence(_c(start), _c(end), F.expr(f"INTERVAL {int(months)} MONTH"))


# D-S9 date_text
def yyyymmdd(d) -> Column:
    return F.date_format(_c(d), "yyyyMMdd")


def dd_mmm_yyyy(d) -> Column:
    return F.date_format(_c(d), "dd-MMM-yyyy")


def parse_iso_date(s) -> Column:
    """Lenient ISO parse: unparsable text → NULL."""
    return F.try_to_date(_c(s), "yyyy-MM-dd")
