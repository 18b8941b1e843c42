"""Queries: trade valuation (D06, W04, P07), VM (A04), collateral report
(D07, W16) and the latest-vs-previous snapshot (D14, A25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesoro.operators import collateral as CO
from tesoro.operators import intervals as I
from tesoro.operators import positions as P
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.registry import query
from tesoro.session import staged

# --- Spark side -------------------------------------------------------------


def kept_trades(t):
    """One row a trade, staged: reports value the trades more than once (every
    load of K02 does), and the lines are shuffled only for the first.  Dealt by
    trade into as many parts as the session shuffles to; AQE would join them by
    the size of the trades, which is a small part of that of their days."""
    def keep(trades):
        return t.memo("kept_trades", lambda: staged(trades, "valued-trades")).repartition(
            int(t.spark.conf.get("spark.sql.shuffle.partitions")), "trade_id")
    return keep


def trade_mtm(t):
    """D06 on the bindings: one row per (report_date, trade) valued."""
    def build():
        dates = P.valuation_dates(B.legs(t), B.bdays(t), B.calendar_end(t), extra_attrs=("step_rate",), keep=kept_trades(t))
        dates = dates.withColumn("step", P.steps_from_rate("step_rate", "report_date"))
        return P.trade_valuation(dates)
    return t.memo("trade_mtm", build)


def report_days(t):
    """Per bank: every business day from its first trade date to the horizon."""
    def build():
        first = B.legs(t).groupBy("bank_id").agg(F.min("trade_date").alias("_first"))
        first = first.withColumn("_end", F.lit(B.calendar_end(t)).cast("date"))
        return I.expand_active(first, B.bdays(t), "_first", "_end", "report_date",
                               inclusive_end=True).select("bank_id", "report_date")
    return t.memo("report_days", build)


def collateral(t):
    return t.memo("collateral", lambda: CO.collateral_report(
        report_days(t), B.exposure(t), trade_mtm(t), ["bank_id"]))


# --- oracle CTEs ------------------------------------------------------------

cte("trades_v", """
SELECT f.trade_id, f.bank_id, f.trade_size_usd, f.step_rate, s.trade_date,
       least(s.last_value, (SELECT end_date FROM cal_end)) AS end_date
FROM (SELECT trade_id, bank_id, trade_size_usd, step_rate FROM legs
      QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY trade_date, bank_id, leg_id) = 1) f
JOIN (SELECT trade_id, min(trade_date) AS trade_date, max(value_date) AS last_value
      FROM legs GROUP BY trade_id) s ON s.trade_id = f.trade_id
""", "legs", "cal_end")

cte("trade_mtm", """
SELECT report_date, trade_id, bank_id, trade_size_usd, cum AS mtm, round(cum * trade_size_usd, 2) AS pnl
FROM (
  SELECT b.report_date, v.trade_id, v.bank_id, v.trade_size_usd,
         CAST(sum(CAST(v.step_rate * CAST((day(b.report_date) % 5) - 2 AS DECIMAL(2,0)) * 0.01 AS DECIMAL(12,6)))
              OVER (PARTITION BY v.trade_id ORDER BY b.report_date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(16,6)) AS cum
  FROM trades_v v JOIN bdays b ON b.report_date >= v.trade_date AND b.report_date <= v.end_date)
""", "trades_v", "bdays")

cte("report_days", """
SELECT f.bank_id, b.report_date
FROM (SELECT bank_id, min(trade_date) AS first_date FROM legs GROUP BY bank_id) f
JOIN bdays b ON b.report_date >= f.first_date AND b.report_date <= (SELECT end_date FROM cal_end)
""", "legs", "bdays", "cal_end")

cte("coll_series", """
SELECT bank_id, report_date, im, vm, need,
       coalesce(lead(need) OVER (PARTITION BY bank_id ORDER BY report_date), need) AS need_next,
       row_number() OVER (PARTITION BY bank_id ORDER BY report_date) AS rn
FROM (
  SELECT r.bank_id, r.report_date,
         CAST(CAST(coalesce(e.exposure, 0) AS DECIMAL(20,2)) * 0.05 AS DECIMAL(20,4)) AS im,
         CAST(coalesce(v.vm, 0) AS DECIMAL(20,4)) AS vm,
         CAST(CAST(CAST(coalesce(e.exposure, 0) AS DECIMAL(20,2)) * 0.05 AS DECIMAL(20,4))
              - CAST(coalesce(v.vm, 0) AS DECIMAL(20,4)) AS DECIMAL(20,4)) AS need
  FROM report_days r
  LEFT JOIN exposure e ON e.bank_id = r.bank_id AND e.report_date = r.report_date
  LEFT JOIN (SELECT bank_id, report_date, sum(pnl) AS vm FROM trade_mtm GROUP BY bank_id, report_date) v
    ON v.bank_id = r.bank_id AND v.report_date = r.report_date)
""", "report_days", "exposure", "trade_mtm")

# Fixed values that must equal the reference's policy, as in
# tesoro.operators.collateral: margin 5 %, buffer 500,000, smallest move
# 50,000, moves in steps of 10,000.
cte("coll_rec", """
SELECT bank_id, 1 AS rn, CAST(0 AS DECIMAL(20,4)) AS posted FROM coll_series WHERE rn = 1
UNION ALL
SELECT s.bank_id, s.rn + 1,
  CAST(CASE WHEN r.posted - s.need < 0 THEN
         CASE WHEN s.need + 500000 - r.posted <= 0 THEN r.posted
              ELSE r.posted + greatest(ceil(CAST(s.need + 500000 - r.posted AS DOUBLE) / 10000) * 10000, 50000) END
       ELSE
         CASE WHEN r.posted - s.need - 500000 < 50000 THEN r.posted
              WHEN least(r.posted - s.need - 500000, r.posted - s.need_next - 500000) < 50000 THEN r.posted
              ELSE greatest(r.posted - greatest(floor(CAST(least(r.posted - s.need - 500000,
                     r.posted - s.need_next - 500000) AS DOUBLE) / 10000) * 10000, 50000), 500000) END
       END AS DECIMAL(20,4))
FROM coll_rec r JOIN coll_series s ON s.bank_id = r.bank_id AND s.rn = r.rn
""", "coll_series", recursive=True)

cte("coll_report", """
SELECT s.bank_id, s.report_date,
       CAST(round(-s.im, 2) AS DOUBLE) AS initial_margin,
       CAST(round(s.vm, 2) AS DOUBLE) AS variation_margin,
       CAST(round(-s.im, 2) + round(s.vm, 2) AS DOUBLE) AS collateral_required,
       CAST(round(r.posted, 2) AS DOUBLE) AS collateral_posted,
       CAST(round(r.posted - s.need, 2) AS DOUBLE) AS excess_deficit
FROM coll_series s JOIN coll_rec r ON r.bank_id = s.bank_id AND r.rn = s.rn
""", "coll_series", "coll_rec")


# --- queries ------------------------------------------------------------------

@query("d06_trade_valuation", sql("""
SELECT report_date, trade_id, bank_id, CAST(mtm AS DOUBLE) AS mtm, CAST(pnl AS DOUBLE) AS pnl,
       CAST(trade_size_usd AS DOUBLE) AS trade_size_usd
FROM trade_mtm
""", "trade_mtm"))
def d06(t):
    return trade_mtm(t).select("report_date", "trade_id", "bank_id",
                               F.col("mtm").cast("double").alias("mtm"),
                               F.col("pnl").cast("double").alias("pnl"),
                               F.col("trade_size_usd").cast("double").alias("trade_size_usd"))


@query("w04_cumulative_mtm", sql("""
SELECT trade_id, count(*) AS days_valued, CAST(max(mtm) AS DOUBLE) AS max_mtm, CAST(min(mtm) AS DOUBLE) AS min_mtm,
       CAST(arg_max(mtm, report_date) AS DOUBLE) AS last_mtm, CAST(arg_max(pnl, report_date) AS DOUBLE) AS last_pnl
FROM trade_mtm GROUP BY trade_id
""", "trade_mtm"))
def w04(t):
    """Per trade: days valued, range of the running MTM and its last level."""
    m = trade_mtm(t)
    return m.groupBy("trade_id").agg(
        F.count(F.lit(1)).alias("days_valued"),
        F.max("mtm").cast("double").alias("max_mtm"), F.min("mtm").cast("double").alias("min_mtm"),
        F.max_by("mtm", "report_date").cast("double").alias("last_mtm"),
        F.max_by("pnl", "report_date").cast("double").alias("last_pnl"))


@query("p07_first_row_attributes", sql("""
SELECT trade_id, bank_id, CAST(trade_size_usd AS DOUBLE) AS trade_size_usd, leg_id FROM legs
QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY trade_date, bank_id, leg_id) = 1
""", "legs"))
def p07(t):
    out = P.first_row_attributes(B.legs(t), "trade_id", ["bank_id", "trade_size_usd", "leg_id"],
                                 ["trade_date", "bank_id", "leg_id"])
    return out.withColumn("trade_size_usd", F.col("trade_size_usd").cast("double"))


@query("a04_vm_by_date", sql("""
SELECT report_date, CAST(sum(pnl) AS DOUBLE) AS variation_margin FROM trade_mtm GROUP BY report_date
""", "trade_mtm"))
def a04(t):
    return trade_mtm(t).groupBy("report_date").agg(F.sum("pnl").cast("double").alias("variation_margin"))


@query("d07_collateral_report", sql("SELECT * FROM coll_report", "coll_report"))
def d07(t):
    return collateral(t)


@query("w16_next_day_value", sql("""
SELECT bank_id, report_date, CAST(need AS DOUBLE) AS need, CAST(need_next AS DOUBLE) AS need_next FROM coll_series
""", "coll_series"))
def w16(t):
    e = B.exposure(t).select("bank_id", "report_date", "exposure")
    v = trade_mtm(t).groupBy("bank_id", "report_date").agg(F.sum("pnl").alias("vm"))
    s = (report_days(t).join(e, ["bank_id", "report_date"], "left").join(v, ["bank_id", "report_date"], "left"))
    need = ((F.coalesce("exposure", F.lit(0)).cast("decimal(20,2)") * F.lit(0.05).cast("decimal(3,2)")).cast("decimal(20,4)")
            - F.coalesce("vm", F.lit(0)).cast("decimal(20,4)")).cast("decimal(20,4)")
    s = CO.next_day_value(s.withColumn("need", need), ["bank_id"], "report_date", "need", "need_next")
    return s.select("bank_id", "report_date", F.col("need").cast("double").alias("need"),
                    F.col("need_next").cast("double").alias("need_next"))


SNAP_SQL = """
SELECT bank_id,
  max(CASE WHEN r = 1 THEN report_date END) AS latest_date,
  max(CASE WHEN r = 2 THEN report_date END) AS previous_date,
  {cols}
FROM (SELECT c.*, coalesce(p.total_portfolio, 0.0) AS total_portfolio, coalesce(p.open_positions, 0.0) AS open_positions,
             row_number() OVER (PARTITION BY c.bank_id ORDER BY c.report_date DESC) AS r
      FROM coll_report c
      LEFT JOIN (SELECT l.bank_id, b.report_date, CAST(sum(l.trade_size_usd) AS DOUBLE) AS total_portfolio,
                        CAST(count(DISTINCT l.trade_id) AS DOUBLE) AS open_positions
                 FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date
                 GROUP BY l.bank_id, b.report_date) p ON p.bank_id = c.bank_id AND p.report_date = c.report_date)
WHERE r <= 2 GROUP BY bank_id
"""


def _snap_cols():
    out = []
    for m in CO.KPI_COLUMNS:
        cur = f"max(CASE WHEN r = 1 THEN {m} END)"
        prev = f"max(CASE WHEN r = 2 THEN {m} END)"
        out += [f"{cur} AS {m}_latest", f"{prev} AS {m}_previous",
                f"coalesce({cur}, 0.0) - coalesce({prev}, 0.0) AS {m}_change"]
    return ",\n  ".join(out)


@query("d14_collateral_snapshot", sql(SNAP_SQL.format(cols=_snap_cols()), "coll_report", "legs", "bdays"))
def d14(t):
    """All seven KPI cards per bank: latest, previous and change."""
    return CO.collateral_snapshot(CO.with_positions(collateral(t), B.legs(t), ["bank_id"]), ["bank_id"], measures=CO.KPI_COLUMNS)
