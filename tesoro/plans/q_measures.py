"""Measure queries (the two BI models' DAX re-expressed): previous-day,
change, jump flag, rolling mean, counts, ratios, texts, role-playing dates,
KPI cards.  Money is summed as DECIMAL on both sides so totals are exact."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tesoro.functions import text as T
from tesoro.operators import calendar as C
from tesoro.operators import limits as L
from tesoro.operators import measures as MS
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.q_collateral import collateral, report_days, trade_mtm
from tesoro.operators.collateral import initial_margin
from tesoro.operators.intervals import exposure_series
from tesoro.plans.q_positions import limits, portfolio
from tesoro.plans.registry import query

D = "decimal(20,2)"
KPIS = ["initial_margin", "variation_margin", "collateral_required", "collateral_posted", "excess_deficit"]


def coll_total(t):
    """Portfolio-level report: the per-bank D07 rows summed per date."""
    return t.memo("coll_total", lambda: collateral(t).groupBy("report_date").agg(
        *[F.sum(F.col(k).cast(D)).cast("double").alias(k) for k in KPIS]))


cte("coll_total", "SELECT report_date, " + ", ".join(
    f"CAST(sum(CAST({k} AS DECIMAL(20,2))) AS DOUBLE) AS {k}" for k in KPIS)
    + " FROM coll_report GROUP BY report_date", "coll_report")

cte("portfolio", """
SELECT b.report_date, l.bank_id, l.trade_id, l.type, l.trade_date, l.value_date, l.currency_pair,
       l.trade_size_usd, l.leg_id
FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date
""", "legs", "bdays")


# --- time intelligence ---------------------------------------------------------

@query("w05_previous_day_value", sql("""
SELECT report_date, collateral_posted, lag(report_date) OVER w AS report_date_prev,
       lag(collateral_posted) OVER w AS collateral_posted_prev
FROM coll_total WINDOW w AS (ORDER BY report_date)
""", "coll_total"))
def w05(t):
    s = coll_total(t).select("report_date", "collateral_posted")
    return MS.previous_day(s, [], "report_date", ["collateral_posted"])


@query("w05_previous_day_in_period", sql("""
SELECT report_date, initial_margin, lag(initial_margin) OVER w AS initial_margin_prev
FROM coll_total WINDOW w AS (PARTITION BY strftime(report_date, '%Y-%m') ORDER BY report_date)
""", "coll_total"))
def w05p(t):
    """Trap19 variant: the previous value is blank on the first day of each
    month (the measure without REMOVEFILTERS on the date dimension)."""
    s = coll_total(t).select("report_date", "initial_margin").withColumn("_ym", F.date_format("report_date", "yyyy-MM"))
    return MS.previous_day(s, [], "report_date", ["initial_margin"], respect_period=["_ym"]).select(
        "report_date", "initial_margin", "initial_margin_prev")


@query("w06_daily_change", sql("""
SELECT report_date, collateral_posted - coalesce(lag(collateral_posted) OVER w, 0) AS posted_change,
       excess_deficit - coalesce(lag(excess_deficit) OVER w, 0) AS excess_change
FROM coll_total WINDOW w AS (ORDER BY report_date)
""", "coll_total"))
def w06(t):
    s = MS.previous_day(coll_total(t), [], "report_date", ["collateral_posted", "excess_deficit"])
    return s.select("report_date",
                    MS.daily_change("collateral_posted", "collateral_posted_prev").alias("posted_change"),
                    MS.daily_change("excess_deficit", "excess_deficit_prev").alias("excess_change"))


@query("w07_pct_change_jump_flag", sql("""
SELECT report_date, pct, CASE WHEN coalesce(pct, 0) > 0.1 THEN 1 ELSE 0 END AS im_jump_flag,
       CASE WHEN coalesce(pct, 0) > 0.1 THEN -initial_margin END AS im_jump_marker
FROM (SELECT report_date, initial_margin,
        CASE WHEN lag(initial_margin) OVER w = 0 THEN NULL
             ELSE (initial_margin - lag(initial_margin) OVER w) / lag(initial_margin) OVER w END AS pct
      FROM coll_total WINDOW w AS (ORDER BY report_date))
""", "coll_total"))
def w07(t):
    s = MS.previous_day(coll_total(t), [], "report_date", ["initial_margin"])
    pct = MS.pct_change("initial_margin", "initial_margin_prev")
    flag = MS.jump_flag(pct)
    return s.select("report_date", pct.alias("pct"), flag.alias("im_jump_flag"),
                    F.when(flag == 1, -F.col("initial_margin")).alias("im_jump_marker"))


@query("w08_rolling_30_day_avg", sql("""
SELECT bank_id, report_date,
       CAST(sum(CAST(initial_margin AS DECIMAL(20,2))) OVER w AS DOUBLE) / CAST(count(initial_margin) OVER w AS DOUBLE) AS im_avg30
FROM coll_report
WINDOW w AS (PARTITION BY bank_id ORDER BY report_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)
""", "coll_report"))
def w08(t):
    """30-calendar-day mean of IM per bank; days without a row are skipped."""
    # the margin follows from the exposure alone: no valuation, no recurrence
    e = B.exposure(t).select("bank_id", "report_date", "exposure")
    s = report_days(t).join(e, ["bank_id", "report_date"], "left").withColumn("_im", initial_margin("exposure").cast(D))
    return MS.rolling_avg(s, ["bank_id"], "report_date", "_im", 30, "im_avg30").select("bank_id", "report_date", "im_avg30")


@query("w17_last_n_dates", sql("""
SELECT date, count(*) AS n_movements FROM movements
WHERE date IN (SELECT DISTINCT date FROM movements ORDER BY date DESC LIMIT 5) GROUP BY date
""", "movements"))
def w17(t):
    return MS.last_n_dates(B.movements(t), "date", 5).groupBy("date").agg(F.count(F.lit(1)).alias("n_movements"))


# --- counts and ratios ---------------------------------------------------------

@query("a06_count_rows_if", sql("""
SELECT report_date, count(*) AS open_trade_rows, count(DISTINCT trade_id) AS open_positions,
       count_if(type = 'swap') AS swap_rows
FROM portfolio GROUP BY report_date
""", "portfolio"))
def a06(t):
    """Open trades as rows (legs × banks) vs open positions as distinct
    trade ids (Trap18), per report date.  Both are running sums of starts and
    ends: rows over legs, positions over trades (a trade's legs start
    together, so it is open from its trade date to its last value date)."""
    legs = B.legs(t).select("trade_id", "trade_date", "value_date", F.when(F.col("type") == "swap", 1).otherwise(0).alias("swap"))
    rows = exposure_series(legs, B.bdays(t), [], "trade_date", "value_date", "swap", out_amount="swap_rows", out_count="open_trade_rows")
    spans = (legs.groupBy("trade_id", "trade_date").agg(F.max("value_date").alias("value_date")).withColumn("one", F.lit(1)))
    open_ = exposure_series(spans, B.bdays(t), [], "trade_date", "value_date", "one", out_amount="_", out_count="open_positions").drop("_")
    return rows.join(open_, "report_date").select("report_date", "open_trade_rows", "open_positions", "swap_rows")


def seen_legs(t):
    """Legs that are active on at least one business day: the first business
    day from the trade date lies before the value date.  No day is expanded
    to tell."""
    rolled = C.roll_to_business_day(B.legs(t), "trade_date", B.trade_calendar(t), "_first")
    return rolled.filter((F.col("_first") >= F.col("trade_date")) & (F.col("_first") < F.col("value_date"))).drop("_first")


@query("a07_distinct_count", sql("""
SELECT count(DISTINCT CASE WHEN type = 'spot' THEN trade_id END) AS spots,
       count(DISTINCT CASE WHEN type = 'forward' THEN trade_id END) AS forwards,
       count(DISTINCT CASE WHEN type = 'swap' THEN trade_id END) AS swaps,
       count(DISTINCT bank_id) AS banks
FROM portfolio
""", "portfolio"))
def a07(t):
    p = seen_legs(t)
    of = lambda ty: F.count_distinct(F.when(F.col("type") == ty, F.col("trade_id")))
    return p.agg(of("spot").alias("spots"), of("forward").alias("forwards"), of("swap").alias("swaps"),
                 F.count_distinct("bank_id").alias("banks"))


@query("a08_distinct_pair_count", sql("""
SELECT count(*) AS total_trades FROM (SELECT DISTINCT trade_id, leg_id FROM portfolio)
""", "portfolio"))
def a08(t):
    """Total Trades: distinct (trade_id, leg_id) pairs, all dates.  The
    numbering makes every leg one pair, so the legs are counted."""
    return seen_legs(t).agg(F.count(F.lit(1)).alias("total_trades"))


@query("j15_role_playing_date_join", sql("""
SELECT c.calendar_date,
       (SELECT count(*) FROM (SELECT DISTINCT trade_id, leg_id, trade_date FROM portfolio) p WHERE p.trade_date = c.calendar_date) AS new_trades,
       (SELECT count(*) FROM (SELECT DISTINCT trade_id, leg_id, value_date FROM portfolio) p WHERE p.value_date = c.calendar_date) AS matured_trades
FROM cal c
""", "cal", "portfolio"))
def j15(t):
    """The calendar joined on trade_date (new) and value_date (matured):
    distinct (trade_id, leg_id) pairs per calendar day, both roles from one
    pass over the legs."""
    role = lambda d, new, old: F.struct(F.col(d).alias("calendar_date"), F.lit(new).alias("n"), F.lit(old).alias("m"))
    days = (seen_legs(t).select(F.inline(F.array(role("trade_date", 1, 0), role("value_date", 0, 1))))
            .groupBy("calendar_date").agg(F.sum("n").alias("new_trades"), F.sum("m").alias("matured_trades")))
    j = B.trade_calendar(t).select("calendar_date").join(days, "calendar_date", "left")
    return j.select("calendar_date", F.coalesce("new_trades", F.lit(0)).alias("new_trades"),
                    F.coalesce("matured_trades", F.lit(0)).alias("matured_trades"))


@query("a09_ratio_of_sums", sql("""
SELECT as_of_date, coalesce(CAST(sum(CAST(counterparty_exposure_usd AS DECIMAL(20,2))) AS DOUBLE)
                  / nullif(CAST(sum(CAST(credit_limit_usd AS DECIMAL(20,2))) AS DOUBLE), 0), 0.0) AS credit_utilisation
FROM limits GROUP BY as_of_date
""", "limits"))
def a09(t):
    l = limits(t)
    return l.groupBy("as_of_date").agg(MS.ratio_of_sums(
        F.sum(F.col("counterparty_exposure_usd").cast(D)).cast("double"),
        F.sum(F.col("credit_limit_usd").cast(D)).cast("double")).alias("credit_utilisation"))


@query("a13_threshold_count_text", sql(f"""
SELECT as_of_date, n_warning, n_breach,
       CASE WHEN n_warning > 0 THEN CAST(n_warning AS VARCHAR) || '{T.WARN_TEXT}' ELSE '{T.WARN_NONE_TEXT}' END AS warning_text,
       CASE WHEN n_breach > 0 THEN CAST(n_breach AS VARCHAR) || '{T.BREACH_TEXT}' ELSE '{T.BREACH_NONE_TEXT}' END AS breach_text
FROM (SELECT as_of_date, count_if(utilisation > 0.75) AS n_warning, count_if(utilisation > 1.0) AS n_breach
      FROM limits GROUP BY as_of_date)
""", "limits"))
def a13(t):
    return L.utilisation_text(limits(t), ["as_of_date"])


@query("a20_selected_value", sql("""
SELECT as_of_date, CASE WHEN count(DISTINCT bank_id) = 1 THEN max(bank_id) END AS breaching_bank
FROM limits WHERE utilisation > 1.0 GROUP BY as_of_date
""", "limits"))
def a20(t):
    """The breaching bank when exactly one bank breaches that day."""
    return limits(t).filter(F.col("utilisation") > L.BREACH_LEVEL).groupBy("as_of_date").agg(
        MS.selected_value("bank_id").alias("breaching_bank"))


SLICER = ("BUILDING", "MACHINERY")


@query("a21_sum_ignoring_filters", sql(f"""
SELECT as_of_date, bank_id, credit_limit_usd, total_limit FROM (
  SELECT *, sum(credit_limit_usd) OVER (PARTITION BY as_of_date) AS total_limit FROM limits)
WHERE bank_id IN {SLICER}
""", "limits"))
def a21(t):
    """Total Limit per as_of_date over all banks, shown next to a bank
    slicer selection (computed before the slicer filter, B04)."""
    l = MS.total_ignoring(limits(t), "credit_limit_usd", ["as_of_date"], "total_limit")
    return l.filter(F.col("bank_id").isin(*SLICER)).select("as_of_date", "bank_id", "credit_limit_usd", "total_limit")


@query("f09_slicer_filter", sql(f"""
SELECT report_date, CAST(sum(exposure) AS DOUBLE) AS exposure FROM exposure
WHERE bank_id IN (SELECT DISTINCT bank_id FROM legs WHERE bank_id IN {SLICER}) GROUP BY report_date
""", "exposure", "legs"))
def f09(t):
    """A slicer on the bank dimension propagated to the fact (semi join)."""
    banks = B.legs(t).select("bank_id").distinct().filter(F.col("bank_id").isin(*SLICER))
    e = B.exposure(t).join(banks, "bank_id", "left_semi")
    return e.groupBy("report_date").agg(F.sum("exposure").cast("double").alias("exposure"))


@query("a22_base_sums", sql("""
SELECT bank_id, year(report_date) AS year, """ + ", ".join(
    f"CAST(sum(CAST({k} AS DECIMAL(20,2))) AS DOUBLE) AS {k}" for k in KPIS) + """
FROM coll_report GROUP BY bank_id, year(report_date)
""", "coll_report"))
def a22(t):
    c = collateral(t).withColumn("year", F.year("report_date"))
    return MS.measure_table(c, ["bank_id", "year"],
                            {k: F.sum(F.col(k).cast(D)).cast("double") for k in KPIS})


@query("a14_group_sum_ranked", sql("""
SELECT currency_pair, CAST(sum(trade_size_usd) AS DOUBLE) AS total_size,
       rank() OVER (ORDER BY sum(trade_size_usd) DESC) AS size_rank
FROM legs GROUP BY currency_pair
""", "legs"))
def a14(t):
    g = B.legs(t).groupBy("currency_pair").agg(F.sum("trade_size_usd").alias("_s"))
    return g.select("currency_pair", F.col("_s").cast("double").alias("total_size"),
                    F.rank().over(Window.orderBy(F.desc("_s"))).alias("size_rank")).orderBy("size_rank")


@query("a15_value_counts", sql("""
SELECT day_name, count(*) AS n FROM dim_date GROUP BY day_name
""", "dim_date"))
def a15(t):
    return B.trade_calendar(t).groupBy("day_name").agg(F.count(F.lit(1)).alias("n"))


@query("a18_weekly_distinct_count", sql("""
SELECT CAST(date_trunc('week', trade_date) AS DATE) AS week_start, count(DISTINCT trade_id) AS trades
FROM legs GROUP BY 1
""", "legs"))
def a18(t):
    l = B.legs(t)
    return l.groupBy(F.date_trunc("week", "trade_date").cast("date").alias("week_start")).agg(
        F.count_distinct("trade_id").alias("trades"))


@query("a19_control_summary", sql("""
SELECT count(*) AS report_rows, max(report_date) AS latest_date, min(excess_deficit) AS min_excess,
       max(collateral_posted) AS max_posted, count_if(excess_deficit < 0) AS deficit_days
FROM coll_total
""", "coll_total"))
def a19(t):
    c = coll_total(t)
    return c.agg(F.count(F.lit(1)).alias("report_rows"), F.max("report_date").alias("latest_date"),
                 F.min("excess_deficit").alias("min_excess"), F.max("collateral_posted").alias("max_posted"),
                 F.count_if(F.col("excess_deficit") < 0).alias("deficit_days"))


@query("a23_identity_consistency", sql("""
SELECT trade_id, count(DISTINCT trade_date) AS trade_dates, count(DISTINCT type) AS types,
       count(DISTINCT leg_id) AS legs FROM legs GROUP BY trade_id
""", "legs"))
def a23(t):
    return B.legs(t).groupBy("trade_id").agg(F.count_distinct("trade_date").alias("trade_dates"),
                                             F.count_distinct("type").alias("types"),
                                             F.count_distinct("leg_id").alias("legs"))


@query("a24_output_inventory", sql("""
SELECT 'portfolio' AS dataset, (SELECT count(*) FROM portfolio) AS n_rows, 9 AS n_columns
UNION ALL SELECT 'trade_mtm', (SELECT count(*) FROM trade_mtm), 6
UNION ALL SELECT 'limits', (SELECT count(*) FROM limits), 5
UNION ALL SELECT 'mtm_report', (SELECT count(*) FROM coll_report), 6
""", "portfolio", "trade_mtm", "limits", "coll_report"))
def a24(t):
    """Rows and columns per produced dataset (the report's inventory)."""
    sets = {"portfolio": portfolio(t), "trade_mtm": trade_mtm(t).select(
        "report_date", "trade_id", "bank_id", "mtm", "pnl", "trade_size_usd"),
        "limits": limits(t).select("as_of_date", "bank_id", "credit_limit_usd", "counterparty_exposure_usd",
                                   "limit_available_usd"),
        "mtm_report": collateral(t).drop("bank_id")}
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in sets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ALL_KPIS = [*KPIS, "total_portfolio", "open_positions"]


@query("a25_latest_vs_previous_cards", sql("""
SELECT """ + ", ".join(
    f"max(CASE WHEN r = 1 THEN {k} END) AS {k}_latest, max(CASE WHEN r = 2 THEN {k} END) AS {k}_previous, "
    f"coalesce(max(CASE WHEN r = 1 THEN {k} END), 0) - coalesce(max(CASE WHEN r = 2 THEN {k} END), 0) AS {k}_change"
    for k in ALL_KPIS) + """
FROM (SELECT c.*, coalesce(p.total_portfolio, 0.0) AS total_portfolio, coalesce(p.open_positions, 0.0) AS open_positions,
             row_number() OVER (ORDER BY c.report_date DESC) AS r
      FROM coll_total c
      LEFT JOIN (SELECT report_date, CAST(sum(trade_size_usd) AS DOUBLE) AS total_portfolio,
                        CAST(count(DISTINCT trade_id) AS DOUBLE) AS open_positions FROM portfolio GROUP BY report_date) p
        ON p.report_date = c.report_date) WHERE r <= 2
""", "coll_total", "portfolio"))
def a25(t):
    """The seven KPI cards over all banks: latest, previous and change."""
    from tesoro.operators.collateral import collateral_snapshot, with_positions
    s = collateral_snapshot(with_positions(coll_total(t), B.legs(t), []).withColumn("_k", F.lit(1)), ["_k"], measures=ALL_KPIS)
    return s.drop("_k", "latest_date", "previous_date")


# --- joins and lookups ------------------------------------------------------------

@query("j03_keyed_lookup_default", sql("""
SELECT r.bank_id, r.report_date, CAST(coalesce(e.exposure, 0) AS DOUBLE) AS exposure,
       CAST(coalesce(v.vm, 0) AS DOUBLE) AS variation_margin
FROM report_days r LEFT JOIN exposure e ON e.bank_id = r.bank_id AND e.report_date = r.report_date
LEFT JOIN (SELECT bank_id, report_date, sum(pnl) AS vm FROM trade_mtm GROUP BY ALL) v
  ON v.bank_id = r.bank_id AND v.report_date = r.report_date
""", "report_days", "exposure", "trade_mtm"))
def j03(t):
    e = B.exposure(t).select("bank_id", "report_date", "exposure")
    v = trade_mtm(t).groupBy("bank_id", "report_date").agg(F.sum("pnl").alias("vm"))
    j = report_days(t).join(e, ["bank_id", "report_date"], "left").join(v, ["bank_id", "report_date"], "left")
    return j.select("bank_id", "report_date", F.coalesce("exposure", F.lit(0)).cast("double").alias("exposure"),
                    F.coalesce("vm", F.lit(0)).cast("double").alias("variation_margin"))


@query("p08_null_default", sql("""
SELECT r.bank_id, r.report_date, CAST(coalesce(v.vm, 0) AS DOUBLE) AS variation_margin
FROM report_days r LEFT JOIN (SELECT bank_id, report_date, sum(pnl) AS vm FROM trade_mtm GROUP BY ALL) v
  ON v.bank_id = r.bank_id AND v.report_date = r.report_date
""", "report_days", "trade_mtm"))
def p08(t):
    v = trade_mtm(t).groupBy("bank_id", "report_date").agg(F.sum("pnl").alias("vm"))
    j = report_days(t).join(v, ["bank_id", "report_date"], "left").fillna(0, subset=["vm"])
    return j.select("bank_id", "report_date", F.col("vm").cast("double").alias("variation_margin"))


@query("j09_next_business_day", sql("""
SELECT trade_date, coalesce((SELECT min(report_date) FROM bdays WHERE report_date >= d.trade_date),
                            (SELECT max(report_date) FROM bdays)) AS rolled_date
FROM (SELECT DISTINCT trade_date FROM legs) d
""", "legs", "bdays"))
def j09(t):
    d = B.legs(t).select("trade_date").distinct()
    return C.roll_to_business_day(d, "trade_date", B.trade_calendar(t), "rolled_date")


@query("j10_previous_date_with_data", sql("""
SELECT c.calendar_date, (SELECT max(report_date) FROM coll_total r WHERE r.report_date < c.calendar_date) AS previous_date_with_data
FROM cal c
""", "cal", "coll_total"))
def j10(t):
    return MS.previous_date_with_data(B.trade_calendar(t), coll_total(t), "report_date")


@query("j14_has_data_semi_join", sql("""
SELECT c.calendar_date, CASE WHEN EXISTS (SELECT 1 FROM coll_total r WHERE r.report_date = c.calendar_date)
                             THEN 'Yes' ELSE 'No' END AS has_data
FROM cal c
""", "cal", "coll_total"))
def j14(t):
    return MS.has_data_flag(B.trade_calendar(t).select("calendar_date"), coll_total(t), "report_date")


@query("j17_limit_exposure_join", sql("""
SELECT s.as_of_date, s.bank_id, rl.credit_limit_usd, CAST(e.exposure AS DOUBLE) AS exposure
FROM sched s JOIN review_limits rl ON rl.bank_id = s.bank_id AND rl.effective_date = s.effective_date
LEFT JOIN exposure e ON e.bank_id = s.bank_id AND e.report_date = s.as_of_date
""", "sched", "review_limits", "exposure"))
def j17(t):
    sched = L.limit_schedule(B.limit_reviews(t), B.bdays(t, "as_of_date"), B.calendar_end(t))
    e = B.exposure(t).select("bank_id", F.col("report_date").alias("as_of_date"),
                             F.col("exposure").cast("double").alias("exposure"))
    return sched.join(e, ["bank_id", "as_of_date"], "left")


@query("t05_largest_first_within_group", sql("""
SELECT as_of_date, bank_id, limit_available_usd,
       row_number() OVER (PARTITION BY as_of_date ORDER BY limit_available_usd DESC, bank_id) AS capacity_rank
FROM limits
""", "limits"))
def t05(t):
    w = Window.partitionBy("as_of_date").orderBy(F.desc("limit_available_usd"), "bank_id")
    return limits(t).select("as_of_date", "bank_id", "limit_available_usd",
                            F.row_number().over(w).alias("capacity_rank"))


@query("p10_sign_inverse", sql("""
SELECT report_date, -initial_margin AS initial_margin_inverse FROM coll_total
""", "coll_total"))
def p10(t):
    return coll_total(t).select("report_date", (-F.col("initial_margin")).alias("initial_margin_inverse"))


@query("p09_derived_money", sql("""
SELECT as_of_date, bank_id, limit_available_usd,
       CAST(round(CAST(counterparty_exposure_usd AS DECIMAL(20,2)) * 0.05, 2) AS DOUBLE) AS initial_margin
FROM limits
""", "limits"))
def p09(t):
    """available = round(limit − exposure, 2) (D05); IM = 5 % of exposure."""
    l = limits(t)
    return l.select("as_of_date", "bank_id", "limit_available_usd",
                    F.round(F.col("counterparty_exposure_usd").cast(D) * F.lit(0.05).cast("decimal(3,2)"), 2)
                    .cast("double").alias("initial_margin"))


@query("c_s1_change_direction", sql(f"""
SELECT report_date, posted_change,
       CASE WHEN posted_change > 0 THEN '{T.UP_MARK}' WHEN posted_change < 0 THEN '{T.DOWN_MARK}' ELSE '{T.FLAT_MARK}' END AS marker,
       CASE WHEN posted_change > 0 THEN '{T.UP_COLOUR}' WHEN posted_change < 0 THEN '{T.DOWN_COLOUR}' ELSE '{T.FLAT_COLOUR}' END AS colour
FROM (SELECT report_date, collateral_posted - coalesce(lag(collateral_posted) OVER (ORDER BY report_date), 0) AS posted_change
      FROM coll_total)
""", "coll_total"))
def cs1(t):
    s = MS.previous_day(coll_total(t), [], "report_date", ["collateral_posted"])
    ch = MS.daily_change("collateral_posted", "collateral_posted_prev")
    return s.select("report_date", ch.alias("posted_change"), T.change_marker(ch).alias("marker"),
                    T.change_colour(ch).alias("colour"))


# Binding: every nation is a "bank" whose code is picked by its key; SANX is
# none of the codes (only whole codes match).
BANK_CODES = ["SAN", "CITI", "HSBC", "JPM", "FXPB", "SANX"]


@query("c_s2_code_map", sql(f"""
SELECT n_name AS bank_id, bank_code,
       CASE bank_code {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in T.BANK_THEME_COLOURS.items())} ELSE '{T.BANK_THEME_DEFAULT}' END AS theme_colour
FROM (SELECT n_name, {BANK_CODES}[n_nationkey % 6 + 1] AS bank_code FROM nation)
"""))
def cs2(t):
    """Bank code → theme colour, by the whole code; default grey."""
    codes = F.array(*[F.lit(c) for c in BANK_CODES])
    b = t("nation").select(F.col("n_name").alias("bank_id"), F.get(codes, (F.col("n_nationkey") % 6).cast("int")).alias("bank_code"))
    return b.withColumn("theme_colour", T.code_map("bank_code", T.BANK_THEME_COLOURS, T.BANK_THEME_DEFAULT))


def _compact_sql(x: str) -> str:
    """The cards' number format: M with two decimals, K with none, else
    grouped digits without decimals."""
    return (f"CASE WHEN abs({x}) >= 1000000 THEN CASE WHEN {x} < 0 THEN '-' ELSE '' END || printf('%.2f', abs({x}) / 1000000.0) || 'M' "
            f"WHEN abs({x}) >= 1000 THEN CASE WHEN {x} < 0 THEN '-' ELSE '' END || printf('%.0f', abs({x}) / 1000.0) || 'K' "
            f"ELSE format('{{:,.0f}}', {x}) END")


def _change_sql(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN '+ ' || {_compact_sql(x)} WHEN {x} < 0 THEN '- ' || {_compact_sql(f'abs({x})')} ELSE '- 0' END"


CARD_TEXTS = ["collateral_posted", "excess_deficit", "variation_margin"]


@query("c_s3_compact_number", sql(f"""
SELECT report_date, {', '.join(f"{_compact_sql(k)} AS {k}_text, {_change_sql(k + '_ch')} AS {k}_change_text" for k in CARD_TEXTS)},
       {_compact_sql('small')} AS small_text, {_change_sql('small')} AS small_change_text
FROM (SELECT report_date, {', '.join(f"{k}, {k} - coalesce(lag({k}) OVER (ORDER BY report_date), 0) AS {k}_ch" for k in CARD_TEXTS)},
             CAST(dayofyear(report_date) * 25 - 4000 AS DOUBLE) AS small FROM coll_total)
""", "coll_total"))
def cs3(t):
    """KPI texts and signed change texts: millions, thousands, units, zero and
    negatives (``small`` runs from -3,975 to 5,150 with the day of the year)."""
    s = MS.previous_day(coll_total(t), [], "report_date", CARD_TEXTS)
    small = (F.dayofyear("report_date") * 25 - 4000).cast("double")
    cols = []
    for k in CARD_TEXTS:
        cols += [T.compact_number(k).alias(f"{k}_text"), T.signed_compact(MS.daily_change(k, f"{k}_prev")).alias(f"{k}_change_text")]
    return s.select("report_date", *cols, T.compact_number(small).alias("small_text"), T.signed_compact(small).alias("small_change_text"))


@query("w11_continuous_workday_index", sql("""
SELECT calendar_date, CASE WHEN isodow(calendar_date) <= 5 THEN
   sum(CASE WHEN isodow(calendar_date) <= 5 THEN 1 ELSE 0 END) OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS workday_index
FROM cal
""", "cal"))
def w11(t):
    return C.workday_index(B.trade_calendar(t)).select("calendar_date", "workday_index")


@query("p12_date_label_latest", sql("""
SELECT calendar_date, CASE WHEN calendar_date = max(calendar_date) OVER () THEN 'Latest Date'
                           ELSE strftime(calendar_date, '%d-%b-%Y') END AS date_label
FROM cal
""", "cal"))
def p12(t):
    return C.latest_date_label(B.trade_calendar(t)).select("calendar_date", "date_label")


@query("t04_sort_by_other_column", sql("""
SELECT DISTINCT year_month, month_name || ' ' || CAST(year AS VARCHAR) AS month_label,
       dense_rank() OVER (ORDER BY year_month) AS sort_key
FROM dim_date
""", "dim_date"))
def t04(t):
    """Month labels ordered by year-month (not alphabetically)."""
    c = B.trade_calendar(t).select("year_month", F.concat_ws(" ", "month_name", F.col("year").cast("string"))
                                   .alias("month_label")).distinct()
    return c.withColumn("sort_key", F.dense_rank().over(Window.orderBy("year_month"))).orderBy("sort_key")


@query("a05_min_max_date", sql("""
SELECT (SELECT max(report_date) FROM coll_report) AS report_high_water_mark,
       (SELECT min(date) FROM movements) AS ledger_history_start,
       (SELECT max(date) FROM movements) AS ledger_high_water_mark,
       (SELECT max(calendar_date) FROM cal) AS latest_calendar_date
""", "coll_report", "movements", "cal"))
def a05(t):
    m = B.movements(t)
    return collateral(t).agg(F.max("report_date").alias("report_high_water_mark")).select(
        "report_high_water_mark",
        m.agg(F.min("date")).scalar().alias("ledger_history_start"),
        m.agg(F.max("date")).scalar().alias("ledger_high_water_mark"),
        B.trade_calendar(t).agg(F.max("calendar_date")).scalar().alias("latest_calendar_date"))


@query("j13_star_dimension_join", sql("""
SELECT a.bank_name, year(m.date) AS year, strftime(m.date, '%B') AS month_name, m.type,
       CAST(sum(m.amount) AS DOUBLE) AS amount, count(*) AS n
FROM movements m JOIN accounts a ON a.account_number = m.account_number
GROUP BY a.bank_name, year(m.date), strftime(m.date, '%B'), m.type
""", "movements", "accounts"))
def j13(t):
    """Fact → account (→ bank, snowflake) and → date dimension, summed at
    the dimension grain.  The account is joined once, on its integer key; the
    fact is reduced to bank, day and type before it meets the calendar."""
    m = B.unnumbered_movements(t).groupBy("bank_name", "date", "type").agg(
        F.sum("amount").alias("_amt"), F.count(F.lit(1)).alias("_n"))
    cal = B.ledger_calendar(t).select(F.col("calendar_date").alias("date"), "year", "month_name")
    j = m.join(cal, "date")
    return j.groupBy("bank_name", "year", "month_name", "type").agg(
        F.sum("_amt").cast("double").alias("amount"), F.sum("_n").alias("n"))
