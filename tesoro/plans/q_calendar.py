"""Calendar queries: D01, J09, W11, P12 and the date scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesoro.operators import calendar as C
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.registry import query

cte("dim_date", """
SELECT calendar_date,
       CAST(year(calendar_date) AS INTEGER) AS year,
       CAST(quarter(calendar_date) AS INTEGER) AS quarter,
       CAST(month(calendar_date) AS INTEGER) AS month,
       strftime(calendar_date, '%B') AS month_name,
       CAST(day(calendar_date) AS INTEGER) AS day,
       CAST(isodow(calendar_date) AS INTEGER) AS day_of_week,
       strftime(calendar_date, '%A') AS day_name,
       CAST(isodow(calendar_date) - 1 AS INTEGER) AS weekday,
       isodow(calendar_date) >= 6 AS is_weekend,
       day(calendar_date) = 1 AS is_month_start,
       calendar_date = last_day(calendar_date) AS is_month_end,
       CAST(weekofyear(calendar_date) AS INTEGER) AS week_num,
       strftime(calendar_date, '%Y-%m') AS year_month,
       CAST(year(calendar_date) AS VARCHAR) || '-Q' || CAST(quarter(calendar_date) AS VARCHAR) AS year_quarter,
       CAST(weekofyear(calendar_date) AS INTEGER) AS iso_week,
       CAST(isoyear(calendar_date) AS INTEGER) AS iso_year,
       isodow(calendar_date) <= 5 AS is_business_day
FROM cal
""", "cal")

cte("dim_date_bd", """
SELECT d.*,
       coalesce(min(CASE WHEN is_business_day THEN calendar_date END)
                  OVER (ORDER BY calendar_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                max(CASE WHEN is_business_day THEN calendar_date END) OVER ()) AS next_bd,
       coalesce(max(CASE WHEN is_business_day THEN calendar_date END)
                  OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                min(CASE WHEN is_business_day THEN calendar_date END) OVER ()) AS prev_bd
FROM dim_date d
""", "dim_date")


@query("d01_build_calendar", sql("SELECT * FROM dim_date_bd", "dim_date_bd"))
def d01(t):
    """The date dimension over the trade span (17 columns + business-day columns)."""
    return B.trade_calendar(t)
