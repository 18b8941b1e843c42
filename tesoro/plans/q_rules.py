"""The measure-language rules (B01–B05) shown on the driver data: each query
contrasts the rule with the naive reading where they differ."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesoro.operators import measures as MS
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.q_collateral import report_days, trade_mtm
from tesoro.plans.registry import query

D = "decimal(20,2)"

cte("bank_day_facts", """
SELECT r.bank_id, r.report_date, e.exposure, v.vm
FROM report_days r
LEFT JOIN exposure e ON e.bank_id = r.bank_id AND e.report_date = r.report_date
LEFT JOIN (SELECT bank_id, report_date, sum(pnl) AS vm FROM trade_mtm GROUP BY ALL) v
  ON v.bank_id = r.bank_id AND v.report_date = r.report_date
""", "report_days", "exposure", "trade_mtm")


def bank_day_facts(t):
    """Each fact aggregated to (bank, day) *before* they are combined."""
    def build():
        e = B.exposure(t).select("bank_id", "report_date", "exposure")
        v = trade_mtm(t).groupBy("bank_id", "report_date").agg(F.sum("pnl").alias("vm"))
        return report_days(t).join(e, ["bank_id", "report_date"], "left").join(v, ["bank_id", "report_date"], "left")
    return t.memo("bank_day_facts", build)


@query("b01_blank_arithmetic", sql("""
SELECT bank_id, report_date,
       CASE WHEN exposure IS NULL AND vm IS NULL THEN NULL
            ELSE CAST(coalesce(exposure, 0) + coalesce(vm, 0) AS DOUBLE) END AS blank_sum,
       CAST(exposure * vm AS DOUBLE) AS blank_product
FROM bank_day_facts""", "bank_day_facts"))
def b01(t):
    """BLANK + x = x and BLANK + BLANK = BLANK (W06's rule); BLANK × x = BLANK."""
    f = bank_day_facts(t)
    both = F.col("exposure").isNull() & F.col("vm").isNull()
    s = F.when(both, F.lit(None)).otherwise(F.coalesce("exposure", F.lit(0)) + F.coalesce("vm", F.lit(0)))
    return f.select("bank_id", "report_date", s.cast("double").alias("blank_sum"),
                    (F.col("exposure") * F.col("vm")).cast("double").alias("blank_product"))


@query("b02_average_skips_blank", sql("""
SELECT bank_id, strftime(report_date, '%Y-%m') AS year_month,
       CAST(sum(vm) AS DOUBLE) / CAST(count(vm) AS DOUBLE) AS avg_vm_skip_blank,
       CAST(sum(coalesce(vm, 0)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_vm_zero_filled
FROM bank_day_facts GROUP BY bank_id, strftime(report_date, '%Y-%m')""", "bank_day_facts"))
def b02(t):
    """Averages skip blank days (never zero-fill first)."""
    f = bank_day_facts(t).withColumn("year_month", F.date_format("report_date", "yyyy-MM"))
    return f.groupBy("bank_id", "year_month").agg(
        (F.sum("vm").cast("double") / F.count("vm").cast("double")).alias("avg_vm_skip_blank"),
        (F.sum(F.coalesce("vm", F.lit(0))).cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_vm_zero_filled"))


@query("b03_blank_comparison", sql("""
SELECT bank_id, count_if(coalesce(vm, 0) > 0.1) AS days_vm_above, count_if(vm IS NULL) AS blank_days
FROM bank_day_facts GROUP BY bank_id""", "bank_day_facts"))
def b03(t):
    """A comparison with BLANK treats it as 0 (``BLANK > 0.1`` is false)."""
    f = bank_day_facts(t)
    return f.groupBy("bank_id").agg(F.count_if(F.coalesce("vm", F.lit(0)) > 0.1).alias("days_vm_above"),
                                    F.count_if(F.col("vm").isNull()).alias("blank_days"))


@query("b04_filter_replacement", sql("""
SELECT p.report_date, p.type, p.n_rows, s.spot_rows
FROM (SELECT report_date, type, count(*) AS n_rows FROM portfolio GROUP BY ALL) p
JOIN (SELECT report_date, count(*) AS spot_rows FROM portfolio WHERE type = 'spot' GROUP BY ALL) s
  ON s.report_date = p.report_date""", "portfolio"))
def b04(t):
    """``CALCULATE(m, type = "spot")`` replaces the type filter of the cell
    but keeps the date filter: computed on the unfiltered fact, then joined
    to the shown grain (report_date × type)."""
    from tesoro.plans.q_positions import portfolio
    p = portfolio(t)
    cells = p.groupBy("report_date", "type").agg(F.count(F.lit(1)).alias("n_rows"))
    spot = p.filter(F.col("type") == "spot").groupBy("report_date").agg(F.count(F.lit(1)).alias("spot_rows"))
    return cells.join(spot, "report_date")


@query("b05_aggregate_before_combine", sql("""
SELECT bank_id, report_date, CAST(exposure AS DOUBLE) AS exposure, CAST(vm AS DOUBLE) AS vm
FROM bank_day_facts""", "bank_day_facts"))
def b05(t):
    """Legs (exposure) and trades (VM) have different grains: each is summed
    to (bank, day) first, then joined — never joined at row level, which
    would repeat a trade's VM once per leg."""
    f = bank_day_facts(t)
    return f.select("bank_id", "report_date", F.col("exposure").cast("double").alias("exposure"),
                    F.col("vm").cast("double").alias("vm"))


# --- J05 and D15 ------------------------------------------------------------------

@query("j05_missing_key_anti_join", sql("""
SELECT calendar_date FROM cal WHERE calendar_date NOT IN (SELECT trade_date FROM legs)""", "cal", "legs"))
def j05(t):
    """Calendar rows not yet stored, where the stored date table holds the
    days that had trades (a left anti join on the key)."""
    stored = B.legs(t).select(F.col("trade_date").alias("calendar_date")).distinct()
    return B.trade_calendar(t).select("calendar_date").join(stored, "calendar_date", "left_anti")


cte("usd_daily", """
SELECT l.date, CAST(round(sum(CAST(l.closing_balance AS DOUBLE) / h.fx_to_usd), 4) AS DECIMAL(38,4)) AS closing_usd,
       CAST(round(sum(CAST(l.total_movements AS DOUBLE) / h.fx_to_usd), 4) AS DECIMAL(38,4)) AS movements_usd
FROM ledger l LEFT JOIN fx_history h ON h.date = l.date AND h.currency = l.currency GROUP BY l.date
""", "ledger", "fx_history")

cte("usd_flows", """
SELECT m.date, round(sum(CASE WHEN m.type = 'Deposit' THEN CAST(m.amount AS DOUBLE) / h.fx_to_usd END), 4) AS deposits_usd,
       round(abs(sum(CASE WHEN m.type = 'Withdraw' THEN CAST(m.amount AS DOUBLE) / h.fx_to_usd END)), 4) AS withdrawals_usd
FROM movements m LEFT JOIN fx_history h ON h.date = m.date AND h.currency = m.currency GROUP BY m.date
""", "movements", "fx_history")


@query("d15_usd_position", sql("""
SELECT d.date, CAST(d.closing_usd AS DOUBLE) AS closing_usd, CAST(d.movements_usd AS DOUBLE) AS movements_usd,
       f.deposits_usd, f.withdrawals_usd,
       CAST(sum(d.movements_usd) OVER (PARTITION BY date_trunc('month', d.date) ORDER BY d.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS mtd_movements_usd,
       CAST(sum(d.movements_usd) OVER (PARTITION BY year(d.date) ORDER BY d.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ytd_movements_usd,
       CASE WHEN d.date = last_day(d.date) THEN CAST(d.closing_usd AS DOUBLE) END AS month_end_closing_usd
FROM usd_daily d LEFT JOIN usd_flows f ON f.date = d.date""", "usd_daily", "usd_flows"))
def d15(t):
    """Balances and movements in USD (J12: amount / fx_to_usd), month- and
    year-to-date (W09/W10), deposits and withdrawals (F07), month-end
    closing (F08).  Facts are summed by day and currency, which have one
    rate, as DECIMAL (so exactly); these sums are converted and summed to day
    grain, and the period windows run over that day series.  What meets the
    rates is bounded by calendar × currencies, as the rates are."""
    from tesoro.operators import fx as FX
    from tesoro.operators.ledger import period_to_date
    from tesoro.plans.q_fx import history
    from tesoro.plans.q_treasury import ledger_sums
    rates = history(t).select("date", "currency", "fx_to_usd")
    led = FX.convert_to_usd(ledger_sums(t), rates, "closing_balance", "_c")
    led = led.withColumn("_m", F.try_divide(F.col("total_movements").cast("double"), F.col("fx_to_usd")))
    # day totals shown to 4 decimals, then carried as DECIMAL so the period
    # sums are exact (a double sum's last bits depend on the order)
    usd = lambda c: F.round(F.sum(c), 4).cast("decimal(38,4)")
    daily = led.groupBy("date").agg(usd("_c").alias("closing_usd"), usd("_m").alias("movements_usd"))
    mv = B.unnumbered_movements(t).groupBy("date", "currency", "type").agg(F.sum("amount").alias("amount"))
    mv = FX.convert_to_usd(mv, rates, "amount", "_u")
    flows = mv.groupBy("date").agg(
        F.round(F.sum(F.when(F.col("type") == "Deposit", F.col("_u"))), 4).alias("deposits_usd"),
        F.round(F.abs(F.sum(F.when(F.col("type") == "Withdraw", F.col("_u")))), 4).alias("withdrawals_usd"))
    j = daily.join(flows, "date", "left").withColumn("_k", F.lit(1))
    j = period_to_date(j, ["_k"], "date", "movements_usd", "month", "mtd_movements_usd")
    j = period_to_date(j, ["_k"], "date", "movements_usd", "year", "ytd_movements_usd")
    dbl = lambda c: F.col(c).cast("double").alias(c)
    return j.select("date", dbl("closing_usd"), dbl("movements_usd"), "deposits_usd", "withdrawals_usd",
                    dbl("mtd_movements_usd"), dbl("ytd_movements_usd"),
                    F.when(F.col("date") == F.last_day("date"), F.col("closing_usd").cast("double"))
                    .alias("month_end_closing_usd"))
