"""Distinct trades of any selection from one state of bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesoro.operators import distinct as X
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import sql
from tesoro.plans.q_measures import SLICER
from tesoro.plans.registry import query


def trade_numbers(t):
    return t.memo("trade_numbers", lambda: X._written(X.numbered_ids(B.legs(t), "trade_id", "trade_date"), "trade-numbers"))


def weekly_state(t):
    """Trades by the week of a leg's value date, bank and currency pair."""
    def build():
        legs = B.legs(t).withColumn("week_start", F.date_trunc("week", "value_date").cast("date"))
        return X._written(X.distinct_state(legs, "trade_id", ["week_start", "bank_id", "currency_pair"], trade_numbers(t)), "trade-weeks")
    return t.memo("weekly_state", build)


@query("a07_distinct_cube", sql("""
SELECT year(date_trunc('week', value_date)) AS value_year, bank_id, currency_pair,
       CAST(grouping(year(date_trunc('week', value_date)), bank_id, currency_pair) AS BIGINT) AS level, count(DISTINCT trade_id) AS trades
FROM legs GROUP BY CUBE (year(date_trunc('week', value_date)), bank_id, currency_pair)
""", "legs"))
def a07_cube(t):
    """Distinct trades of every roll-up of year, bank and currency pair."""
    state = weekly_state(t).withColumn("value_year", F.year("week_start").cast("long"))
    return X.distinct_cube(state, ["value_year", "bank_id", "currency_pair"], "trades")


@query("a18_rolling_weeks_distinct", sql("""
SELECT k.week_start, count(DISTINCT w.trade_id) AS trades_4w
FROM (SELECT DISTINCT CAST(date_trunc('week', value_date) AS DATE) AS week_start FROM legs) k
JOIN (SELECT DISTINCT CAST(date_trunc('week', value_date) AS DATE) + s.d AS week_start, trade_id
      FROM legs, (VALUES (0), (7), (14), (21)) s(d)) w ON w.week_start = k.week_start
GROUP BY 1
""", "legs"))
def a18_rolling(t):
    """Distinct trades with a value date in a week or the three before it;
    weekly counts do not add up to it, weekly sets do."""
    return X.distinct_rolling(weekly_state(t), "week_start", 7, 4, out="trades_4w")


@query("a21_distinct_ignoring_filters", sql(f"""
SELECT currency_pair, count(DISTINCT CASE WHEN bank_id IN {SLICER} THEN trade_id END) AS trades,
       (SELECT count(DISTINCT trade_id) FROM legs WHERE bank_id IN {SLICER}) AS trades_all_pairs,
       (SELECT count(DISTINCT trade_id) FROM legs) AS trades_all
FROM legs GROUP BY currency_pair
""", "legs"))
def a21_distinct(t):
    """Distinct trades a currency pair under a bank slicer, next to the
    totals that ignore the pair, and the slicer too."""
    state = weekly_state(t)
    picked = state.where(F.col("bank_id").isin(*SLICER))
    pairs = state.select("currency_pair").distinct()
    own = X.distinct_counts(picked, ["currency_pair"], "trades")
    return pairs.join(own, "currency_pair", "left").select(
        "currency_pair", F.coalesce("trades", F.lit(0).cast("long")).alias("trades"),
        X.distinct_counts(picked, [], "n").scalar().alias("trades_all_pairs"),
        X.distinct_counts(state, [], "n").scalar().alias("trades_all"))
