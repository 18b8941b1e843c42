"""BI measures re-expressed as DataFrame operators (A*, W05–W08, B*, C-S1).

A measure is a Column expression evaluated by ``groupBy(*dims).agg`` at any
grain; time-intelligence measures are windows over a *day-grain aggregate*
(B05: aggregate each fact to the shown dims before combining), so every
window is bounded by keys × days, never by fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def measure_table(fact: DataFrame, dims: list[str], measures: dict[str, Column],
                  rollup: bool = False) -> DataFrame:
    """Evaluate named measures at the grain ``dims`` (``rollup=True``
    adds the subtotal levels, the BI engine's totals row)."""
    g = fact.rollup(*dims) if rollup else fact.groupBy(*dims)
    return g.agg(*[c.alias(n) for n, c in measures.items()])


def previous_day(series: DataFrame, keys: list[str], date_col: str, measures: list[str],
                 respect_period: list[str] | None = None, suffix: str = "_prev") -> DataFrame:
    """Each measure at the previous date *with data* (lag over the
    day-grain series).  ``respect_period`` (Trap19) adds period columns to
    the partition, so the first day of each period has no previous value —
    the variant without REMOVEFILTERS on the date dimension."""
    w = Window.partitionBy(*keys, *(respect_period or [])).orderBy(date_col)
    out = series.withColumn(f"{date_col}{suffix}", F.lag(date_col).over(w))
    for m in measures:
        out = out.withColumn(f"{m}{suffix}", F.lag(m).over(w))
    return out


def daily_change(cur: Column | str, prev: Column | str) -> Column:
    """W06 (B01): value − previous, a blank side counting as 0; blank when
    both are blank."""
    cur = F.col(cur) if isinstance(cur, str) else cur
    prev = F.col(prev) if isinstance(prev, str) else prev
    return F.when(cur.isNull() & prev.isNull(), F.lit(None)).otherwise(
        F.coalesce(cur, F.lit(0)) - F.coalesce(prev, F.lit(0)))


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """(m − prev) / prev, blank when prev is 0 or blank (N-S5)."""
    cur = F.col(cur) if isinstance(cur, str) else cur
    prev = F.col(prev) if isinstance(prev, str) else prev
    return F.when(prev == 0, F.lit(None)).otherwise(F.try_divide(cur - prev, prev))


def jump_flag(pct: Column, threshold: float = 0.1) -> Column:
    """W07 (B03): 1 if pct > threshold, blank compared as 0."""
    return F.when(F.coalesce(pct, F.lit(0.0)) > threshold, F.lit(1)).otherwise(F.lit(0))


def rolling_avg(series: DataFrame, keys: list[str], date_col: str, value_col: str, days: int = 30,
                out_col: str | None = None) -> DataFrame:
    """W08 (B02): mean over the ``days`` calendar days ending today
    (today − days + 1 … today); days without data are skipped, not zeroed.
    A RANGE frame on the day number, so gaps in the series are handled.
    Decimals are summed exactly before the division."""
    dn = F.datediff(F.col(date_col), F.lit(EPOCH).cast("date"))
    w = Window.partitionBy(*keys).orderBy(dn).rangeBetween(-(days - 1), 0)
    mean = F.sum(value_col).over(w).cast("double") / F.count(value_col).over(w).cast("double")
    return series.withColumn(out_col or f"{value_col}_avg{days}", mean)


def ratio_of_sums(num: Column | str, den: Column | str) -> Column:
    """Σnum / Σden, 0 when the denominator is 0 or blank."""
    n = F.sum(num) if isinstance(num, str) else num
    d = F.sum(den) if isinstance(den, str) else den
    return F.coalesce(F.when(d == 0, F.lit(None)).otherwise(F.try_divide(n, d)), F.lit(0.0))


def selected_value(c: str) -> Column:
    """The value when exactly one distinct value is in scope, else NULL."""
    return F.when(F.count_distinct(F.col(c)) == 1, F.max(c))


def total_ignoring(df: DataFrame, value_col: str, keep: list[str], out_col: str) -> DataFrame:
    """Σ value over the ``keep`` columns only, computed *before*
    any other filter is applied (ALLEXCEPT)."""
    return df.withColumn(out_col, F.sum(value_col).over(Window.partitionBy(*keep)))


def last_n_dates(df: DataFrame, date_col: str, n: int) -> DataFrame:
    """Rows on the last ``n`` distinct dates.  The ranking runs over the
    distinct dates (bounded by the calendar); the facts are then semi-joined."""
    d = df.select(date_col).distinct()
    d = d.withColumn("_r", F.dense_rank().over(Window.orderBy(F.desc(date_col)))).filter(F.col("_r") <= n)
    return df.join(d.select(date_col), date_col, "left_semi")


def has_data_flag(calendar: DataFrame, fact: DataFrame, fact_date: str, out_col: str = "has_data",
                  yes: str = "Yes", no: str = "No") -> DataFrame:
    """Calendar day → Yes/No if the fact has rows that day (left join
    on the fact's distinct dates)."""
    d = fact.select(F.col(fact_date).alias("calendar_date")).distinct().withColumn("_hit", F.lit(True))
    j = calendar.join(d, "calendar_date", "left")
    return j.withColumn(out_col, F.when(F.col("_hit"), F.lit(yes)).otherwise(F.lit(no))).drop("_hit")


def previous_date_with_data(calendar: DataFrame, fact: DataFrame, fact_date: str,
                            out_col: str = "previous_date_with_data") -> DataFrame:
    """For each calendar date, the latest fact date strictly before it
    (as-of backward, strict) — a running max over the bounded calendar."""
    d = fact.select(F.col(fact_date).alias("calendar_date")).distinct().withColumn("_d", F.col("calendar_date"))
    j = calendar.select("calendar_date").join(d, "calendar_date", "left")
    w = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, -1)
    return j.withColumn(out_col, F.max("_d").over(w)).drop("_d")
