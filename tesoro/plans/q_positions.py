"""Queries over the FX collateral star: positions, exposure, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesoro.operators import intervals as I
from tesoro.operators import limits as L
from tesoro.operators.asof import as_of_join
from tesoro.operators.ranged import RANGE_ROWS, has_wide_groups
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import sql
from tesoro.plans.registry import query

PORTFOLIO_COLS = ["report_date", "bank_id", "trade_id", "type", "trade_date", "value_date",
                  "currency_pair", "trade_size_usd", "leg_id"]


def portfolio(t):
    """J08 on the bindings: one row per (report_date, leg) while active."""
    rows = I.expand_active(B.legs(t), B.bdays(t), "trade_date", "value_date", "report_date")
    return rows.select(*PORTFOLIO_COLS)


@query("j08_active_interval_join", sql("""
SELECT b.report_date, l.bank_id, l.trade_id, l.type, l.trade_date, l.value_date, l.currency_pair,
       CAST(l.trade_size_usd AS DOUBLE) AS trade_size_usd, l.leg_id
FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date
""", "legs", "bdays"))
def j08(t):
    return portfolio(t).withColumn("trade_size_usd", F.col("trade_size_usd").cast("double"))


@query("f05_active_position_filter", sql("""
SELECT count(*) AS active_rows, CAST(sum(l.trade_size_usd) AS DOUBLE) AS active_size,
       CAST(sum(CASE WHEN b.report_date = l.value_date THEN 1 ELSE 0 END) AS BIGINT) AS rows_on_value_date
FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date
""", "legs", "bdays"))
def f05(t):
    """Active rows under ``trade_date <= d < value_date``; a leg never shows
    on its own value date (the reference's property test)."""
    p = portfolio(t).filter(I.active_predicate("report_date", "trade_date", "value_date"))
    return p.agg(F.count(F.lit(1)).alias("active_rows"),
                 F.sum("trade_size_usd").cast("double").alias("active_size"),
                 F.sum(F.when(F.col("report_date") == F.col("value_date"), 1).otherwise(0))
                 .cast("long").alias("rows_on_value_date"))


@query("a02_exposure_by_date_bank", sql("""
SELECT report_date, bank_id, CAST(exposure AS DOUBLE) AS exposure, active_legs FROM exposure
""", "exposure"))
def a02(t):
    return B.exposure(t).select("report_date", "bank_id", F.col("exposure").cast("double").alias("exposure"),
                                "active_legs")


@query("d02_expand_positions", sql("""
SELECT report_date, bank_id, count(*) AS active_legs, CAST(sum(trade_size_usd) AS DOUBLE) AS exposure
FROM (SELECT b.report_date, l.bank_id, l.trade_size_usd
      FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date)
GROUP BY report_date, bank_id
""", "legs", "bdays"))
def d02_expand(t):
    """D02 expansion form: group the expanded rows (checks the delta form)."""
    return (portfolio(t).groupBy("report_date", "bank_id")
            .agg(F.count(F.lit(1)).alias("active_legs"),
                 F.sum("trade_size_usd").cast("double").alias("exposure")))


@query("a03_exposure_by_date", sql("""
SELECT report_date, CAST(sum(exposure) AS DOUBLE) AS exposure,
       CAST(sum(exposure) * 0.05 AS DOUBLE) AS initial_margin_raw
FROM exposure GROUP BY report_date
""", "exposure"))
def a03(t):
    e = B.exposure(t).groupBy("report_date").agg(F.sum("exposure").alias("_e"))
    return e.select("report_date", F.col("_e").cast("double").alias("exposure"),
                    (F.col("_e") * F.lit(0.05).cast("decimal(3,2)")).cast("double").alias("initial_margin_raw"))


@query("j11_limit_as_of_join", sql("""
SELECT s.as_of_date, s.bank_id, rl.credit_limit_usd
FROM sched s JOIN review_limits rl ON rl.bank_id = s.bank_id AND rl.effective_date = s.effective_date
""", "sched", "review_limits"))
def j11(t):
    return L.limit_schedule(B.limit_reviews(t), B.bdays(t, "as_of_date"), B.calendar_end(t))


@query("d05_limit_utilisation", sql("""
SELECT as_of_date, bank_id, credit_limit_usd, counterparty_exposure_usd, limit_available_usd,
       utilisation, utilisation > 0.75 AS is_warning, utilisation > 1.0 AS is_breach
FROM limits
""", "limits"))
def d05(t):
    return limits(t)


def limits(t):
    return t.memo("limits", lambda: L.limit_utilisation(
        B.limit_reviews(t), B.exposure(t), B.bdays(t, "as_of_date"), B.calendar_end(t)))


# --- as-of join on instants ---------------------------------------------------------

@query("j11_as_of_instants", """
WITH views AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts),
     purchases AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, v.event_id AS view_id,
       CASE WHEN epoch_us(p.ts) - epoch_us(v.ts) <= 86400000000 THEN v.event_id END AS view_of_the_day
FROM purchases p ASOF LEFT JOIN views v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def as_of_instants(t):
    """Each purchase with the user's last view at or before it, and with that
    view if it is at most a day old."""
    e = t("events")
    views, purchases = e.where("event_type = 'view'"), e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    wide = RANGE_ROWS if has_wide_groups(e.where("event_type IN ('view', 'purchase')"), ["user_id"]) else None
    found = as_of_join(purchases, views, ["user_id"], "ts", "ts", {"view_id": "event_id", "_viewed": "ts"}, tie=["event_id"], rows=wide)
    day = F.expr("timestampdiff(MICROSECOND, _viewed, ts)") <= 86_400_000_000
    return found.select("event_id", "user_id", "view_id", F.when(day, F.col("view_id")).alias("view_of_the_day"))
