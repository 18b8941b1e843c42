"""Booking-side operators re-aimed as table operators: value-date rules
(D13), daily trade ids (W12, R-S1, Q04), capacity and eligibility (D10,
W14), greedy split across banks (W13, D11).

Trades (bindings): one per order — type from the order status, trade date
the order date, tenor in months = the order priority digit (1–5), size =
the order's leg total.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tesoro.functions import text as T
from tesoro.operators import calendar as C
from tesoro.operators import limits as L
from tesoro.operators import positions as P
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.q_positions import limits
from tesoro.plans.registry import query

def trades(t):
    def build():
        o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        size = B.legs(t).groupBy("trade_id").agg(F.sum("trade_size_usd").alias("trade_size_usd"))
        o = o.select(F.col("o_orderkey").alias("trade_id"),
                     F.when(F.col("o_orderstatus") == "F", "spot").when(F.col("o_orderstatus") == "O", "forward")
                     .when(F.col("o_orderstatus") == "P", "swap").alias("type"),
                     F.to_date("o_orderdate").alias("trade_date"),
                     F.substring("o_orderpriority", 1, 1).cast("int").alias("tenor_months"))
        return o.join(size, "trade_id")
    return t.memo("trades", build)


def value_calendar(t):
    """Calendar from the first trade to past the last raw value date,
    whatever the longest tenor."""
    def build():
        lo, hi = C.date_bounds(P.raw_value_dates(trades(t)), "trade_date", "raw_value_date")
        return C.build_calendar(t.spark, lo, hi + dt.timedelta(days=14))
    return t.memo("value_calendar", build)


cte("trades", """
SELECT o.o_orderkey AS trade_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'spot' WHEN 'O' THEN 'forward' WHEN 'P' THEN 'swap' END AS type,
       CAST(o.o_orderdate AS DATE) AS trade_date, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS tenor_months,
       s.trade_size_usd
FROM orders o JOIN (SELECT trade_id, sum(trade_size_usd) AS trade_size_usd FROM legs GROUP BY trade_id) s
  ON s.trade_id = o.o_orderkey
""", "legs")

cte("trade_ids", """
SELECT trade_id AS order_key, trade_date, type,
       CASE type WHEN 'spot' THEN 'SP' WHEN 'forward' THEN 'FW' ELSE 'SW' END || strftime(trade_date, '%Y%m%d')
       || lpad(CAST(row_number() OVER (PARTITION BY trade_date ORDER BY trade_id) AS VARCHAR), 4, '0') AS new_trade_id,
       row_number() OVER (PARTITION BY trade_date ORDER BY trade_id) AS seq
FROM trades
""", "trades")

cte("booked", """
SELECT t.*, coalesce((SELECT min(report_date) FROM bdays WHERE report_date >= t.trade_date),
                     (SELECT max(report_date) FROM bdays)) AS booking_date
FROM trades t
""", "trades", "bdays")

cte("capacity", """
SELECT trade_id, booking_date, bank_id, trade_size_usd, has_limit, remaining_usd, eligible,
       CASE WHEN eligible THEN CAST(remaining_usd AS DOUBLE)
            / CAST(sum(CASE WHEN eligible THEN remaining_usd END) OVER (PARTITION BY trade_id) AS DOUBLE) END AS weight
FROM (SELECT *, has_limit AND remaining_usd >= CAST(trade_size_usd AS DECIMAL(20,2)) * 1.1 AS eligible
      FROM (SELECT t.trade_id, t.booking_date, b.bank_id, t.trade_size_usd, l.bank_id IS NOT NULL AS has_limit,
                   CAST(greatest(coalesce(CAST(l.credit_limit_usd AS DECIMAL(20,2))
                                          - CAST(l.counterparty_exposure_usd AS DECIMAL(20,2)), 0), 0) AS DECIMAL(20,2)) AS remaining_usd
            FROM booked t, (SELECT DISTINCT c_mktsegment AS bank_id FROM customer) b
            LEFT JOIN limits l ON l.as_of_date = t.booking_date AND l.bank_id = b.bank_id))
""", "booked", "limits")

cte("alloc", """
SELECT trade_id, bank_id, remaining_usd, need,
       greatest(0, least(remaining_usd, need - coalesce(sum(remaining_usd) OVER (PARTITION BY trade_id
            ORDER BY remaining_usd DESC, bank_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS allocated_usd
FROM (SELECT trade_id, bank_id, remaining_usd, CAST(trade_size_usd AS DECIMAL(18,2)) AS need
      FROM capacity WHERE remaining_usd > 0)
""", "capacity")


def capacity(t):
    """Every trade against every bank on its booking date (the trade date
    rolled to a business day, J09)."""
    def build():
        booked = C.roll_to_business_day(trades(t), "trade_date", B.trade_calendar(t), "booking_date")
        banks = t("customer").select(F.col("c_mktsegment").alias("bank_id")).distinct()
        return L.capacity_eligibility(booked, limits(t), banks, B.bdays(t, "booking_date"), date_col="booking_date")
    return t.memo("capacity", build)


cte("vcal", """
SELECT CAST(g.d AS DATE) AS d FROM (SELECT min(trade_date) AS lo, max(trade_date) AS hi FROM trades) b,
  generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi + INTERVAL 2 YEAR AS TIMESTAMP), INTERVAL 1 DAY) g(d)
""", "trades")


@query("d13_value_date_rules", sql("""
SELECT t.trade_id, l.leg_id, l.raw_value_date,
       coalesce((SELECT min(c.d) FROM vcal c WHERE c.d >= l.raw_value_date AND isodow(c.d) <= 5),
                (SELECT max(c.d) FROM vcal c WHERE isodow(c.d) <= 5)) AS value_date
FROM trades t, LATERAL (
  SELECT 1 AS leg_id, CASE t.type WHEN 'spot' THEN t.trade_date + 1 WHEN 'forward' THEN CAST(t.trade_date + to_months(t.tenor_months) AS DATE)
                            ELSE t.trade_date + 2 END AS raw_value_date
  UNION ALL SELECT 2, CAST(t.trade_date + to_months(t.tenor_months) AS DATE) WHERE t.type = 'swap') l
""", "trades", "vcal"))
def d13(t):
    out = P.value_date_rules(trades(t), value_calendar(t))
    return out.select("trade_id", F.col("leg_id").cast("int").alias("leg_id"), "raw_value_date", "value_date")





@query("w12_daily_sequence_id", sql("SELECT order_key, new_trade_id FROM trade_ids", "trade_ids"))
def w12(t):
    """Trade ids = type code + yyyymmdd + 4-digit daily number; the 10,000th
    trade of a day fails the query (see :func:`daily_sequence_id`)."""
    tr = trades(t)
    code = T.code_map(F.col("type"), T.TRADE_TYPE_CODES)
    out = P.daily_sequence_id(tr, "trade_date", code, ["trade_id"], width=4, out_col="new_trade_id", rows=B.day_rows(t, "orders", "o_orderdate"))
    return out.select(F.col("trade_id").alias("order_key"), "new_trade_id")


@query("r_s1_regex_id_check", sql("""
SELECT count_if(regexp_full_match(new_trade_id, '(SP|FW|SW)\\d{12}')) AS valid_ids,
       count_if(NOT regexp_full_match(new_trade_id, '(SP|FW|SW)\\d{12}')) AS invalid_ids,
       count(DISTINCT new_trade_id) = count(*) AS unique_ids
FROM trade_ids""", "trade_ids"))
def rs1(t):
    ids = w12(t)
    ok = T.is_valid_trade_id("new_trade_id")
    return ids.agg(F.count_if(ok).alias("valid_ids"), F.count_if(~ok).alias("invalid_ids"),
                   (F.count_distinct("new_trade_id") == F.count(F.lit(1))).alias("unique_ids"))


@query("q04_sequence_overflow", sql("""
SELECT max(seq) AS max_daily_sequence, max(seq) > 9999 AS overflow FROM trade_ids
""", "trade_ids"))
def q04(t):
    tr = trades(t)
    out = P.dense_sequence(tr, ["trade_date"], ["trade_id"], rows=B.day_rows(t, "orders", "o_orderdate"))
    return out.agg(F.max("seq").alias("max_daily_sequence"),
                   (F.max("seq") > P.MAX_DAILY_SEQUENCE).alias("overflow"))


@query("d10_capacity_eligibility", sql("""
SELECT trade_id, bank_id, booking_date, has_limit, CAST(remaining_usd AS DOUBLE) AS remaining_usd, eligible, weight FROM capacity
""", "capacity"))
def d10(t):
    """Every trade × every bank; ``has_limit`` is false before the bank's
    first limit (nothing remaining, never eligible)."""
    return capacity(t).select("trade_id", "bank_id", "booking_date", "has_limit",
                              F.col("remaining_usd").cast("double").alias("remaining_usd"), "eligible", "weight")


@query("w14_share_of_total", sql("""
SELECT trade_id, bank_id, CAST(remaining_usd AS DOUBLE) / CAST(sum(remaining_usd) OVER (PARTITION BY trade_id) AS DOUBLE) AS share
FROM capacity WHERE remaining_usd > 0
""", "capacity"))
def w14(t):
    c = capacity(t).filter(F.col("remaining_usd") > 0)
    tot = F.sum("remaining_usd").over(Window.partitionBy("trade_id"))
    return c.select("trade_id", "bank_id", (F.col("remaining_usd").cast("double") / tot.cast("double")).alias("share"))


@query("w13_running_allocation", sql("""
SELECT trade_id, bank_id, CAST(allocated_usd AS DOUBLE) AS allocated_usd FROM alloc
""", "alloc"))
def w13(t):
    """Greedy allocation of each trade over that day's banks, largest
    remaining capacity first."""
    c = capacity(t).filter(F.col("remaining_usd") > 0).withColumn(
        "_need", F.col("trade_size_usd").cast("decimal(18,2)"))
    out = P.running_allocation(c, ["trade_id"], "remaining_usd", "_need",
                               [F.desc("remaining_usd"), F.col("bank_id")], "allocated_usd")
    return out.select("trade_id", "bank_id", F.col("allocated_usd").cast("double").alias("allocated_usd"))


cte("split", """
SELECT a.trade_id, a.bank_id, a.need,
       a.allocated_usd + CASE WHEN a.last_rank = 1 THEN a.need - a.total_alloc ELSE 0 END AS allocated_usd
FROM (SELECT *, sum(allocated_usd) OVER (PARTITION BY trade_id) AS total_alloc,
             row_number() OVER (PARTITION BY trade_id ORDER BY remaining_usd ASC, bank_id DESC) AS last_rank
      FROM alloc WHERE allocated_usd > 0
        AND trade_id IN (SELECT trade_id FROM capacity GROUP BY trade_id HAVING count_if(eligible) = 0
                         AND sum(remaining_usd) >= max(CAST(trade_size_usd AS DECIMAL(18,2))))) a
""", "alloc", "capacity")


def split(t):
    c = capacity(t)
    unplaced = c.groupBy("trade_id").agg(F.count_if("eligible").alias("_e")).filter(F.col("_e") == 0)
    c = c.join(unplaced.select("trade_id"), "trade_id", "left_semi").withColumn("need_usd", F.col("trade_size_usd"))
    return P.split_across_banks(c, capacity_col="remaining_usd", need_col="need_usd")


@query("d11_split_across_banks", sql("""
SELECT trade_id, bank_id, CAST(allocated_usd AS DOUBLE) AS allocated_usd FROM split
""", "split"))
def d11(t):
    """Trades no single bank can take (no eligible bank) split across banks;
    trades whose total capacity falls short are rejected (no rows)."""
    return split(t).select("trade_id", "bank_id", F.col("allocated_usd").cast("double").alias("allocated_usd"))


@query("d11_split_legs", sql("""
SELECT trade_id, bank_id, leg_id,
       CAST(CASE WHEN leg_id = max(leg_id) OVER w
                 THEN allocated_usd - (sum(part) OVER w - part) ELSE part END AS DOUBLE) AS split_amount_usd
FROM (SELECT s.trade_id, s.bank_id, l.leg_id, s.allocated_usd,
             CAST(round(CAST(l.trade_size_usd AS DOUBLE) * (CAST(s.allocated_usd AS DOUBLE) / CAST(s.need AS DOUBLE)), 2) AS DECIMAL(18,2)) AS part
      FROM split s JOIN legs l ON l.trade_id = s.trade_id)
WINDOW w AS (PARTITION BY trade_id, bank_id)
""", "split", "legs"))
def d11_legs(t):
    """The legs of split trades: each bank's share of every leg, the last leg
    taking the cents left by rounding."""
    need = trades(t).select("trade_id", F.col("trade_size_usd").alias("need_usd"))
    legs = B.legs(t).select("trade_id", "leg_id", F.col("trade_size_usd").alias("leg_amount_usd"))
    out = P.split_legs_pro_rata(split(t).join(need, "trade_id"), legs)
    return out.select("trade_id", "bank_id", "leg_id", F.col("split_amount_usd").cast("double").alias("split_amount_usd"))
