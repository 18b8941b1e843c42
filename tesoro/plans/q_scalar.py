"""Scalar-function queries (D-S*, N-S*, M-S1, R-S2) over whole driver
tables: every distinct trade date, every exposure row, every event."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tesoro.functions import dates as DS
from tesoro.functions import money as M
from tesoro.functions import text as T
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.q_positions import limits
from tesoro.plans.registry import query

cte("tdates", "SELECT DISTINCT trade_date AS d FROM legs", "legs")


def tdates(t):
    return B.legs(t).select(F.col("trade_date").alias("d")).distinct()


@query("d_s1_date_parts", sql("""
SELECT d, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day FROM tdates
""", "tdates"))
def ds1(t):
    p = DS.date_parts("d")
    return tdates(t).select("d", *[p[k].alias(k) for k in ("year", "quarter", "month", "day")])


@query("d_s2_date_names", sql("""
SELECT d, strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name FROM tdates
""", "tdates"))
def ds2(t):
    return tdates(t).select("d", DS.month_name("d").alias("month_name"), DS.day_name("d").alias("day_name"))


@query("d_s3_weekday_numbers", sql("""
SELECT d, CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(isodow(d) - 1 AS INTEGER) AS weekday FROM tdates
""", "tdates"))
def ds3(t):
    return tdates(t).select("d", DS.iso_day_of_week("d").alias("day_of_week"), DS.weekday0("d").alias("weekday"))


@query("d_s4_iso_week_year", sql("""
SELECT d, CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(isoyear(d) AS INTEGER) AS iso_year FROM tdates
""", "tdates"))
def ds4(t):
    return tdates(t).select("d", DS.iso_week("d").alias("iso_week"), DS.iso_year("d").cast("int").alias("iso_year"))


@query("d_s5_date_flags", sql("""
SELECT d, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end FROM tdates
""", "tdates"))
def ds5(t):
    return tdates(t).select("d", DS.is_weekend("d").alias("is_weekend"), DS.is_month_start("d").alias("is_month_start"),
                            DS.is_month_end("d").alias("is_month_end"))


@query("d_s6_period_labels", sql("""
SELECT d, strftime(d, '%Y-%m') AS year_month, CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter
FROM tdates""", "tdates"))
def ds6(t):
    return tdates(t).select("d", DS.year_month("d").alias("year_month"), DS.year_quarter("d").alias("year_quarter"))


@query("d_s7_date_arithmetic", sql("""
SELECT d, d + 1 AS next_day, d - 7 AS week_before, CAST(d + INTERVAL 6 MONTH AS DATE) AS plus_6_months FROM tdates
""", "tdates"))
def ds7(t):
    return tdates(t).select("d", DS.add_days("d", 1).alias("next_day"), DS.add_days("d", -7).alias("week_before"),
                            DS.add_months("d", 6).alias("plus_6_months"))


@query("d_s8_date_sequence", sql("""
SELECT count(*) AS days, count_if(isodow(g.d) <= 5) AS weekdays,
       (SELECT count(*) FROM generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 6 MONTH)) AS half_years
FROM (SELECT min(d) AS lo, max(d) AS hi FROM tdates) b,
     generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)
GROUP BY b.lo, b.hi
""", "tdates"))
def ds8(t):
    """Daily, Mon–Fri and 6-month sequences over the trade-date span."""
    b = tdates(t).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = DS.day_sequence("lo", "hi")
    return b.select(
        F.size(days).cast("long").alias("days"),
        F.size(F.filter(days, lambda x: F.weekday(x) < 5)).cast("long").alias("weekdays"),
        F.size(DS.month_step_sequence("lo", "hi", 6)).cast("long").alias("half_years"))


@query("d_s9_date_text", sql("""
SELECT d, strftime(d, '%Y%m%d') AS yyyymmdd, strftime(d, '%d-%b-%Y') AS display, CAST(strftime(d, '%Y-%m-%d') AS DATE) AS parsed
FROM tdates""", "tdates"))
def ds9(t):
    return tdates(t).select("d", DS.yyyymmdd("d").alias("yyyymmdd"), DS.dd_mmm_yyyy("d").alias("display"),
                            DS.parse_iso_date(F.date_format("d", "yyyy-MM-dd")).alias("parsed"))


@query("n_s1_round_money", sql("""
SELECT bank_id, report_date, CAST(round(exposure * 0.05, 2) AS DOUBLE) AS im_2dp,
       CAST(round(CAST(exposure AS DECIMAL(20,2)) / 7, 6) AS DOUBLE) AS seventh_6dp
FROM exposure""", "exposure"))
def ns1(t):
    e = B.exposure(t)
    return e.select("bank_id", "report_date",
                    M.round2(F.col("exposure") * F.lit(Decimal("0.05"))).cast("double").alias("im_2dp"),
                    M.round6(F.col("exposure").cast("decimal(20,2)") / F.lit(7)).cast("double").alias("seventh_6dp"))


@query("n_s2_round_to_step", sql("""
SELECT bank_id, report_date,
       round(CAST(exposure AS DOUBLE) / 250000) * 250000 AS nearest_250k,
       ceil(CAST(exposure AS DOUBLE) / 10000) * 10000 AS ceil_10k,
       floor(CAST(exposure AS DOUBLE) / 10000) * 10000 AS floor_10k
FROM exposure""", "exposure"))
def ns2(t):
    x = F.col("exposure").cast("double")
    return B.exposure(t).select("bank_id", "report_date",
                                M.round_to_step(x, 250000.0).alias("nearest_250k"),
                                M.ceil_to_step(x, 10000.0).cast("double").alias("ceil_10k"),
                                M.floor_to_step(x, 10000.0).cast("double").alias("floor_10k"))


@query("n_s3_clamp", sql("""
SELECT as_of_date, bank_id, greatest(limit_available_usd, 0) AS remaining_floor0,
       least(utilisation, 1.0) AS utilisation_capped
FROM limits""", "limits"))
def ns3(t):
    l = limits(t)
    return l.select("as_of_date", "bank_id", M.floor_at_zero("limit_available_usd").cast("double").alias("remaining_floor0"),
                    M.clamp("utilisation", hi=1.0).alias("utilisation_capped"))


@query("n_s4_abs_sign", sql("""
SELECT CAST(sign(amount) AS INTEGER) AS sign_class, count(*) AS n, CAST(sum(abs(amount)) AS DOUBLE) AS abs_total
FROM movements GROUP BY 1""", "movements"))
def ns4(t):
    m = B.movements(t)
    return m.groupBy(M.sign_class("amount").alias("sign_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs("amount")).cast("double").alias("abs_total"))


@query("n_s5_safe_divide", sql("""
SELECT as_of_date, bank_id, CASE WHEN credit_limit_usd = 0 THEN NULL
       ELSE counterparty_exposure_usd / credit_limit_usd END AS utilisation_or_blank
FROM limits""", "limits"))
def ns5(t):
    l = limits(t)
    return l.select("as_of_date", "bank_id", M.safe_divide("counterparty_exposure_usd", "credit_limit_usd")
                    .alias("utilisation_or_blank"))


@query("m_s1_map_get", sql("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract(props, '$.missing') AS INTEGER) AS missing
FROM events""", ))
def ms1(t):
    """Map lookups with NULL for an absent key, on the events' JSON props."""
    e = t("events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return e.select("event_id", T.map_get("m", "k").alias("k"), T.map_get("m", "missing").alias("missing"))


@query("r_s2_text_build", sql("""
SELECT transaction_id, replace(CAST(date AS VARCHAR), '-', '') AS date_key,
       substr(transaction_id, 3, 8) = replace(CAST(date AS VARCHAR), '-', '') AS id_matches_date
FROM movements""", "movements"))
def rs2(t):
    """Ids rebuilt from parts: ISO date with dashes stripped, checked
    against the stored transaction ids."""
    m = B.movements(t)
    key = T.strip_dashes(F.col("date").cast("string"))
    return m.select("transaction_id", key.alias("date_key"),
                    (F.substring("transaction_id", 3, 8) == key).alias("id_matches_date"))
