"""Interval (active-position) operators: J08 active_interval_join, F05
active_position_filter, D02 expand_positions / exposure_series.

Spark has no interval-join strategy, so a range predicate
``start <= d < end`` against a calendar would plan as a nested loop.  Both
forms here turn it into equi work:

* expansion: ``explode(sequence(start, end))`` then a broadcast *semi* join to
  the business days — used only when per-day rows are the output;
* delta: +amount at ``start``, −amount at ``end``, pre-aggregated per
  (key, day), then a running sum per key — O(rows) instead of
  O(Σ durations), used whenever only daily totals are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active_predicate(d: Column | str, start: str, end: str, inclusive_end: bool = False) -> Column:
    """``start <= d < end`` (or ``<= end`` for the inclusive kind, Trap5)."""
    d = F.col(d) if isinstance(d, str) else d
    upper = d <= F.col(end) if inclusive_end else d < F.col(end)
    return (F.col(start) <= d) & upper


def expand_active(df: DataFrame, business_days: DataFrame, start: str, end: str,
                  date_col: str = "report_date", inclusive_end: bool = False) -> DataFrame:
    """One row per (input row, business day) while the row is active.

    ``business_days`` is a one-column calendar of business dates named
    ``date_col``; it is bounded by the calendar span; the planner broadcasts it by its size.
    """
    last = F.col(end) if inclusive_end else F.date_sub(F.col(end), 1)
    rows = (df.filter(last >= F.col(start))
            .withColumn(date_col, F.explode(F.sequence(F.col(start), last))))
    return rows.join(business_days, date_col, "left_semi")


def exposure_series(df: DataFrame, business_days: DataFrame, keys: list[str], start: str,
                    end: str, amount: str, date_col: str = "report_date",
                    out_amount: str = "exposure", out_count: str = "active_legs",
                    inclusive_end: bool = False) -> DataFrame:
    """D02 (delta form): Σ amount of rows active on each business day, per key.

    Result rows exist only for (key, day) with at least one active row, exactly
    like grouping the expanded rows of :func:`expand_active`.
    """
    stop = F.date_add(F.col(end), 1) if inclusive_end else F.col(end)
    valid = df.filter(stop > F.col(start))
    # both events of a row in one pass over the facts
    event = lambda d, amt, n: F.struct(d.alias("_d"), amt.alias("_amt"), F.lit(n).alias("_n"))
    signed = df.schema[amount].dataType.simpleString() if amount in df.columns else None
    minus = (-F.col(amount)).cast(signed) if signed else -F.col(amount)
    events = valid.select(*keys, F.inline(F.array(event(F.col(start), F.col(amount), 1), event(stop, minus, -1))))
    # Map-side partial aggregation collapses the events to one row per
    # (key, day) before the shuffle; what reaches the window is bounded by
    # keys × calendar days regardless of how many legs a key has.
    daily = (events.groupBy(*keys, "_d")
             .agg(F.sum("_amt").alias("_amt"), F.sum("_n").alias("_n")))
    w = Window.partitionBy(*keys).orderBy("_d")
    run = Window.partitionBy(*keys).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    seg = (daily
           .withColumn(out_amount, F.sum("_amt").over(run))
           .withColumn(out_count, F.sum("_n").over(run))
           .withColumn("_next", F.lead("_d").over(w))
           .filter(F.col(out_count) > 0))
    # every open segment ends at a later event, so _next is never NULL here
    days = seg.withColumn(date_col, F.explode(F.sequence(F.col("_d"), F.date_sub(F.col("_next"), 1))))
    days = days.join(business_days, date_col, "left_semi")
    return days.select(*keys, date_col, out_amount, F.col(out_count).cast("long").alias(out_count))
