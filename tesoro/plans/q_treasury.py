"""Queries over the treasury ledger star: totals, roll-forward, sweeps,
period-to-date, month-end interest, latest snapshots."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tesoro.operators import ledger as LG
from tesoro.operators import sweep as SW
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.registry import query
from tesoro.session import staged

INTEREST_RATE = 0.001  # binding parameter for D12 (the reference draws it at random)

# --- oracle CTEs ------------------------------------------------------------

cte("accounts", """
SELECT CAST(r.r_regionkey AS VARCHAR) AS bank_id, r.r_name AS bank_name,
       CAST(s.s_suppkey AS VARCHAR) AS account_number, n.n_name AS currency,
       CAST(s.s_acctbal AS DECIMAL(18,2)) AS opening_balance
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")

cte("movements", """
SELECT date,
       'TX' || strftime(date, '%Y%m%d') || lpad(CAST(row_number() OVER (PARTITION BY date
            ORDER BY l_orderkey, l_linenumber, l_partkey, account_number, l_quantity,
                     l_extendedprice, l_returnflag, l_linestatus) AS VARCHAR), 6, '0') AS transaction_id,
       account_number, currency,
       CASE kind WHEN 'W' THEN 'Withdraw' WHEN 'C' THEN 'Charges' ELSE 'Deposit' END AS type,
       CASE kind WHEN 'W' THEN 'Transactions' WHEN 'C' THEN 'Fees' ELSE 'Transactions' END AS category,
       CAST(CASE kind WHEN 'W' THEN -price WHEN 'D' THEN price
                      WHEN 'C' THEN -round(price * 0.01, 2) ELSE round(price * 0.5, 2) END AS DECIMAL(18,2)) AS amount,
       CASE kind WHEN 'W' THEN 'Withdraw movement' WHEN 'C' THEN 'Bank charges' ELSE 'Deposit movement' END AS description
FROM (SELECT CAST(l.l_shipdate AS DATE) AS date, CAST(l.l_suppkey AS VARCHAR) AS account_number, a.currency,
             CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price, l.l_orderkey, l.l_linenumber, l.l_partkey,
             l.l_quantity, l.l_extendedprice, l.l_returnflag, l.l_linestatus,
             CASE WHEN l.l_returnflag = 'R' THEN 'W' WHEN l.l_returnflag = 'A' THEN 'D'
                  WHEN l.l_linestatus = 'F' THEN 'C' ELSE 'H' END AS kind
      FROM lineitem l JOIN accounts a ON a.account_number = CAST(l.l_suppkey AS VARCHAR))
""", "accounts")

cte("mov_daily", """
SELECT account_number, date, sum(amount) AS total_movements FROM movements GROUP BY account_number, date
""", "movements")

cte("led_days", """
SELECT CAST(g.d AS DATE) AS date FROM (SELECT min(date) AS lo, max(date) AS hi FROM mov_daily) b,
  generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)
""", "mov_daily")

cte("w15", """
SELECT d.date, a.account_number, a.currency,
       CAST(a.opening_balance + sum(coalesce(m.total_movements, 0)) OVER w - coalesce(m.total_movements, 0) AS DECIMAL(28,2)) AS starting_balance,
       CAST(coalesce(m.total_movements, 0) AS DECIMAL(28,2)) AS total_movements,
       CAST(a.opening_balance + sum(coalesce(m.total_movements, 0)) OVER w AS DECIMAL(28,2)) AS closing_balance
FROM accounts a CROSS JOIN led_days d
LEFT JOIN mov_daily m ON m.account_number = a.account_number AND m.date = d.date
WINDOW w AS (PARTITION BY a.account_number ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""", "mov_daily", "led_days", "accounts")

cte("sw_sides", """
SELECT date, currency, account_number, bal,
       CASE WHEN bal < 0 THEN coalesce(sum(-bal) OVER (PARTITION BY date, currency, bal < 0 ORDER BY bal, account_number
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS d_lo,
       CASE WHEN bal > 0 THEN coalesce(sum(bal) OVER (PARTITION BY date, currency, bal > 0 ORDER BY bal DESC, account_number
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS s_lo
FROM (SELECT date, currency, account_number, CAST(closing_balance AS DECIMAL(18,2)) AS bal FROM w15 WHERE closing_balance <> 0)
""", "w15")

cte("sw_water", """
SELECT d.date, d.currency, d.account_number AS deficit_acct, s.account_number AS surplus_acct,
       CAST(least(d.d_lo - d.bal, s.s_lo + s.bal) - greatest(d.d_lo, s.s_lo) AS DECIMAL(18,2)) AS amount
FROM sw_sides d JOIN sw_sides s ON s.date = d.date AND s.currency = d.currency AND d.bal < 0 AND s.bal > 0
 AND d.d_lo < s.s_lo + s.bal AND s.s_lo < d.d_lo - d.bal
""", "sw_sides")

cte("sw_snap", """
SELECT d.date, d.currency, d.account_number AS deficit_acct, s.account_number AS surplus_acct,
       CAST(least(s.bal, -d.bal - s.s_lo) AS DECIMAL(18,2)) AS amount
FROM sw_sides d JOIN sw_sides s ON s.date = d.date AND s.currency = d.currency AND d.bal < 0 AND s.bal > 0
 AND s.s_lo < -d.bal
""", "sw_sides")

SWEEP_LEGS = """
SELECT date, 'SWEEP-' || deficit_acct || '-' || surplus_acct AS transaction_id, deficit_acct AS account_number,
       currency, 'Internal Sweep' AS type, 'Treasury' AS category, CAST(amount AS DOUBLE) AS amount,
       'Sweep from ' || surplus_acct AS description FROM {t}
UNION ALL
SELECT date, 'SWEEP-' || surplus_acct || '-' || deficit_acct, surplus_acct, currency, 'Internal Sweep', 'Treasury',
       CAST(-amount AS DOUBLE), 'Sweep to ' || deficit_acct FROM {t}
"""

cte("led_bounds", "SELECT min(date) AS lo, max(date) AS hi FROM movements", "movements")

cte("led_rec", """
SELECT (SELECT lo FROM led_bounds) - 1 AS date, account_number, currency,
       CAST(0 AS DECIMAL(18,2)) AS starting_balance, CAST(0 AS DECIMAL(18,2)) AS total_movements,
       CAST(0 AS DECIMAL(18,2)) AS sweep_amount, CAST(opening_balance AS DECIMAL(18,2)) AS closing_balance
FROM accounts
UNION ALL
SELECT date, account_number, currency, starting_balance, total_movements,
       CAST(sw AS DECIMAL(18,2)), CAST(pre + sw AS DECIMAL(18,2))
FROM (
  SELECT *, CASE WHEN pre < 0 THEN least(-pre, greatest(s_tot - d_before, 0))
                 WHEN pre > 0 THEN -least(pre, greatest(d_tot - s_before, 0)) ELSE 0 END AS sw
  FROM (
    SELECT *,
      sum(CASE WHEN pre < 0 THEN -pre ELSE 0 END) OVER (PARTITION BY currency) AS d_tot,
      sum(CASE WHEN pre > 0 THEN pre ELSE 0 END) OVER (PARTITION BY currency) AS s_tot,
      coalesce(sum(-pre) OVER (PARTITION BY currency, pre < 0 ORDER BY pre, account_number
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d_before,
      coalesce(sum(pre) OVER (PARTITION BY currency, pre > 0 ORDER BY pre DESC, account_number
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s_before
    FROM (
      SELECT r.date + 1 AS date, r.account_number, r.currency, r.closing_balance AS starting_balance,
             CAST(coalesce(m.total_movements, 0) AS DECIMAL(18,2)) AS total_movements,
             r.closing_balance + CAST(coalesce(m.total_movements, 0) AS DECIMAL(18,2)) AS pre
      FROM led_rec r LEFT JOIN mov_daily m ON m.account_number = r.account_number AND m.date = r.date + 1
      WHERE r.date < (SELECT hi FROM led_bounds))))
""", "accounts", "led_bounds", "mov_daily", recursive=True)

cte("ledger", "SELECT * FROM led_rec WHERE date >= (SELECT lo FROM led_bounds)", "led_rec", "led_bounds")


# --- Spark side -------------------------------------------------------------

def w15(t):
    """Daily balances of every account without sweeps.  They are read by both
    sides of the sweep and by the closing join, so their steps (one row an
    account and day with a movement) are staged once; the accounts × days are
    written out of them by each reader."""
    def build():
        lo, hi = B.ledger_bounds(t)
        return LG.daily_balances(staged(LG.balance_steps(B.accounts(t), B.movements(t), lo, hi)))
    return t.memo("w15", build)


def sweeps(t, mode):
    return t.memo(f"sweeps_{mode}", lambda: SW.sweep_allocation(
        w15(t).filter(F.col("closing_balance") != 0), mode))


def rolled_ledger(t):
    """D09 output; it reads no movement's number, so none is made."""
    lo, hi = B.ledger_bounds(t)
    return LG.ledger_roll_forward(B.accounts(t), B.unnumbered_movements(t), lo, hi, mode="waterfall")


def ledger(t):
    """D09 output, staged: the recurrence is serial per currency, so its
    result is written once to the shared checkpoint folder — every reader
    (and a retry after an executor loss) reads it instead of replaying the
    day-by-day kernel."""
    return t.memo("ledger", lambda: staged(rolled_ledger(t)))


def ledger_sums(t):
    """The ledger's closing balances and movements summed by day and currency.
    These sums are staged instead of the accounts × days, which are added up
    as they are made, unless an earlier query has staged them."""
    def build():
        led = ledger(t) if t.known("ledger") else rolled_ledger(t)
        return staged(led.groupBy("date", "currency").agg(F.sum("closing_balance").alias("closing_balance"),
                                                          F.sum("total_movements").alias("total_movements")), "ledger-sums")
    return t.memo("ledger_sums", build)


def _dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# --- queries ------------------------------------------------------------------

@query("a01_sum_by_key", sql("""
SELECT account_number, CAST(sum(amount) AS DOUBLE) AS total_movements, count(*) AS n_movements
FROM movements GROUP BY account_number
""", "movements"))
def a01(t):
    return (B.movements(t).groupBy("account_number")
            .agg(F.sum("amount").cast("double").alias("total_movements"),
                 F.count(F.lit(1)).alias("n_movements")))


@query("j01_left_join_totals", sql("""
SELECT a.account_number, a.currency, CAST(a.opening_balance + coalesce(e.tot, 0) AS DOUBLE) AS starting_balance,
       CAST(coalesce(m.tot, 0) AS DOUBLE) AS total_movements,
       CAST(a.opening_balance + coalesce(e.tot, 0) + coalesce(m.tot, 0) AS DOUBLE) AS closing_balance
FROM accounts a
LEFT JOIN (SELECT account_number, sum(amount) AS tot FROM movements
           WHERE date = (SELECT max(date) FROM movements) GROUP BY account_number) m ON m.account_number = a.account_number
LEFT JOIN (SELECT account_number, sum(amount) AS tot FROM movements
           WHERE date < (SELECT max(date) FROM movements) GROUP BY account_number) e ON e.account_number = a.account_number
""", "accounts", "movements"))
def j01(t):
    """The last day of the reference's loop: every account starts from its
    opening balance and all earlier movements; the latest day's movements are
    summed (missing → 0), closing = starting + total (P08, P09).  One
    aggregate over the movements serves both sums."""
    mv = B.movements(t)
    last = mv.agg(F.max("date")).scalar()
    part = lambda c: F.sum(F.when(c, F.col("amount")))
    tot = mv.groupBy("account_number").agg(part(F.col("date") == last).alias("_tot"), part(F.col("date") < last).alias("_before"))
    j = B.accounts(t).join(tot, "account_number", "left")
    total, start = F.coalesce(F.col("_tot"), F.lit(0)), F.col("opening_balance") + F.coalesce(F.col("_before"), F.lit(0))
    return j.select("account_number", "currency", start.cast("double").alias("starting_balance"),
                    total.cast("double").alias("total_movements"), (start + total).cast("double").alias("closing_balance"))


@query("w15_balance_roll_forward", sql("""
SELECT date, account_number, currency, CAST(starting_balance AS DOUBLE) AS starting_balance,
       CAST(total_movements AS DOUBLE) AS total_movements, CAST(closing_balance AS DOUBLE) AS closing_balance
FROM w15""", "w15"))
def q_w15(t):
    return w15(t).select("date", "account_number", "currency",
                         *_dbl("starting_balance", "total_movements", "closing_balance"))


@query("d08_sweep_allocation", sql(SWEEP_LEGS.format(t="sw_water"), "sw_water"))
def d08(t):
    mv, _ = sweeps(t, "waterfall")
    return mv.withColumn("amount", F.col("amount").cast("double"))


@query("d08_sweep_snapshot_mode", sql(SWEEP_LEGS.format(t="sw_snap"), "sw_snap"))
def d08s(t):
    mv, _ = sweeps(t, "snapshot")
    return mv.withColumn("amount", F.col("amount").cast("double"))


@query("j16_deficit_surplus_join", sql("""
SELECT date, currency, deficit_acct, surplus_acct, CAST(amount AS DOUBLE) AS amount FROM sw_snap
""", "sw_snap"))
def j16(t):
    tr = SW.sweep_transfers(w15(t).filter(F.col("closing_balance") != 0), mode="snapshot")
    return tr.withColumn("amount", F.col("amount").cast("double"))


@query("d08_sweep_closing", sql("""
SELECT b.date, b.account_number, b.currency,
       CAST(b.closing_balance + coalesce(s.amt, 0) AS DOUBLE) AS closing_balance,
       CAST(coalesce(s.amt, 0) AS DOUBLE) AS sweep_amount
FROM w15 b LEFT JOIN (SELECT date, account_number, sum(amount) AS amt FROM (
    SELECT date, deficit_acct AS account_number, amount FROM sw_water
    UNION ALL SELECT date, surplus_acct, -amount FROM sw_water) GROUP BY date, account_number) s
  ON s.date = b.date AND s.account_number = b.account_number
WHERE b.closing_balance <> 0
""", "w15", "sw_water"))
def d08c(t):
    _, bal = sweeps(t, "waterfall")
    return bal.select("date", "account_number", "currency", *_dbl("closing_balance", "sweep_amount"))


@query("d09_ledger_roll_forward", sql("""
SELECT date, account_number, currency, CAST(starting_balance AS DOUBLE) AS starting_balance,
       CAST(total_movements AS DOUBLE) AS total_movements, CAST(sweep_amount AS DOUBLE) AS sweep_amount,
       CAST(closing_balance AS DOUBLE) AS closing_balance
FROM ledger""", "ledger"))
def d09(t):
    return ledger(t).select("date", "account_number", "currency",
                            *_dbl("starting_balance", "total_movements", "sweep_amount", "closing_balance"))


@query("d12_month_end_interest", sql(f"""
SELECT date, 'TX' || strftime(date, '%Y%m%d') || lpad(CAST(row_number() OVER (PARTITION BY date
         ORDER BY CAST(account_number AS BIGINT)) AS VARCHAR), 6, '0') AS transaction_id,
       account_number, currency, 'Interest' AS type, 'Income' AS category,
       CAST(round(starting_balance * CAST({INTEREST_RATE} AS DECIMAL(10,6)), 2) AS DOUBLE) AS amount,
       'Month-end interest' AS description
FROM ledger WHERE date = last_day(date)
""", "ledger"))
def d12(t):
    from tesoro.operators.positions import daily_sequence_id
    mv = LG.month_end_interest(ledger(t), B.ledger_calendar(t), INTEREST_RATE)
    # a month end touches every account: numbered in ranges of account numbers
    mv = mv.withColumn("_acct", F.col("account_number").cast("long"))
    mv = daily_sequence_id(mv, "date", F.lit("TX"), ["_acct"], width=6, out_col="transaction_id", step=1_000_000)
    return mv.select("date", "transaction_id", "account_number", "currency", "type", "category",
                     F.col("amount").cast("double").alias("amount"), "description")


@query("d16_sweep_decomposition", sql("""
SELECT x.date, x.currency, x.movements_ex_sweeps, x.sweeps_only, CAST(w.closing AS DOUBLE) AS closing_without_sweeps
FROM (SELECT date, currency, CAST(sum(CASE WHEN type IS DISTINCT FROM 'Internal Sweep' THEN amount ELSE 0 END) AS DOUBLE) AS movements_ex_sweeps,
             CAST(sum(CASE WHEN type = 'Internal Sweep' THEN amount ELSE 0 END) AS DOUBLE) AS sweeps_only
      FROM (SELECT date, currency, type, CAST(amount AS DECIMAL(18,2)) AS amount FROM movements
            UNION ALL SELECT date, currency, type, CAST(amount AS DECIMAL(18,2)) FROM ({legs}))
      GROUP BY date, currency) x
JOIN (SELECT date, currency, sum(closing_balance) AS closing FROM w15 GROUP BY date, currency) w
  ON w.date = x.date AND w.currency = x.currency
""".replace("{legs}", SWEEP_LEGS.format(t="sw_water")), "movements", "sw_water", "w15"))
def d16(t):
    """Movements with and without sweeps, and the closing balance that the
    movements without sweeps give (opening + movements so far)."""
    mv, _ = sweeps(t, "waterfall")
    out = LG.sweep_decomposition(B.movements(t).unionByName(mv), ["date", "currency"])
    closing = w15(t).groupBy("date", "currency").agg(F.sum("closing_balance").alias("closing_without_sweeps"))
    return out.join(closing, ["date", "currency"]).select(
        "date", "currency", *_dbl("movements_ex_sweeps", "sweeps_only", "closing_without_sweeps"))


@query("w09_month_to_date", sql("""
SELECT account_number, date, CAST(total_movements AS DOUBLE) AS total_movements,
       CAST(sum(total_movements) OVER (PARTITION BY account_number, date_trunc('month', date) ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS mtd_movements,
       CAST(abs(sum(CASE WHEN total_movements < 0 THEN total_movements ELSE 0 END) OVER (PARTITION BY account_number,
            date_trunc('month', date) ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS DOUBLE) AS mtd_outflows
FROM mov_daily""", "mov_daily"))
def w09(t):
    d = (B.movements(t).groupBy("account_number", "date").agg(F.sum("amount").alias("total_movements"))
         .withColumn("_out", F.when(F.col("total_movements") < 0, F.col("total_movements")).otherwise(F.lit(0))))
    d = LG.period_to_date(d, ["account_number"], "date", "total_movements", "month", "mtd_movements")
    d = LG.period_to_date(d, ["account_number"], "date", "_out", "month", "_mtd_out")
    return d.select("account_number", "date", *_dbl("total_movements", "mtd_movements"),
                    F.abs("_mtd_out").cast("double").alias("mtd_outflows"))


@query("w10_year_to_date", sql("""
SELECT account_number, date, CAST(sum(total_movements) OVER (PARTITION BY account_number, year(date) ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ytd_movements
FROM mov_daily""", "mov_daily"))
def w10(t):
    d = B.movements(t).groupBy("account_number", "date").agg(F.sum("amount").alias("total_movements"))
    d = LG.period_to_date(d, ["account_number"], "date", "total_movements", "year", "ytd_movements")
    return d.select("account_number", "date", F.col("ytd_movements").cast("double").alias("ytd_movements"))


@query("f06_latest_snapshot_filter", sql("""
SELECT date, account_number, CAST(closing_balance AS DOUBLE) AS closing_balance FROM ledger
WHERE date = (SELECT max(date) FROM ledger)""", "ledger"))
def f06(t):
    led = ledger(t)
    last = led.agg(F.max("date")).scalar()
    return led.filter(F.col("date") == last).select("date", "account_number", *_dbl("closing_balance"))


@query("a11_last_value_per_key", sql("""
SELECT account_number, CAST(arg_max(closing_balance, date) AS DOUBLE) AS latest_closing, max(date) AS latest_date
FROM w15 GROUP BY account_number""", "w15"))
def a11(t):
    return w15(t).groupBy("account_number").agg(
        F.max_by("closing_balance", "date").cast("double").alias("latest_closing"),
        F.max("date").alias("latest_date"))


@query("j02_left_join_latest_balance", sql("""
SELECT a.account_number, a.currency, CAST(coalesce(l.closing_balance, 100000.00) AS DOUBLE) AS starting_balance
FROM accounts a LEFT JOIN (SELECT account_number, closing_balance FROM w15
                           WHERE date = (SELECT max(date) FROM w15)) l ON l.account_number = a.account_number
""", "accounts", "w15"))
def j02(t):
    """Resume point: accounts ⟕ the balances at the latest stored date; an
    account absent that day starts from the default 100,000."""
    b = w15(t)
    last = b.agg(F.max("date")).scalar()
    lat = b.filter(F.col("date") == last).select("account_number", "closing_balance")
    j = B.accounts(t).join(lat, "account_number", "left")
    return j.select("account_number", "currency", F.coalesce(
        F.col("closing_balance"), F.lit(LG.DEFAULT_OPENING).cast("decimal(18,2)")).cast("double").alias("starting_balance"))


@query("a12_min_max_measure", sql("""
SELECT account_number, CAST(max(closing_balance) AS DOUBLE) AS highest_balance,
       CAST(min(closing_balance) AS DOUBLE) AS lowest_balance, CAST(max(starting_balance) AS DOUBLE) AS open_balance
FROM ledger GROUP BY account_number""", "ledger"))
def a12(t):
    return ledger(t).groupBy("account_number").agg(
        F.max("closing_balance").cast("double").alias("highest_balance"),
        F.min("closing_balance").cast("double").alias("lowest_balance"),
        F.max("starting_balance").cast("double").alias("open_balance"))


@query("t02_top_k", sql("""
SELECT date, transaction_id, account_number, type, CAST(amount AS DOUBLE) AS amount FROM movements
ORDER BY date DESC, transaction_id DESC LIMIT 5""", "movements"))
def t02(t):
    """Latest five movements (the top-k report; tie key = transaction id).
    They lie within the latest five dates, so only those are numbered."""
    m = B.unnumbered_movements(t)
    dates = m.select("date").distinct().orderBy(F.desc("date")).limit(5)
    recent = B.numbered_movements(t, m.join(F.broadcast(dates), "date", "left_semi"))   # five rows
    return (recent.orderBy(F.desc("date"), F.desc("transaction_id")).limit(5)
            .select("date", "transaction_id", "account_number", "type", F.col("amount").cast("double").alias("amount")))


@query("f07_type_filter_measure", sql("""
SELECT currency,
  CAST(sum(CASE WHEN type = 'Deposit' THEN amount END) AS DOUBLE) AS deposits,
  CAST(abs(sum(CASE WHEN type = 'Withdraw' THEN amount END)) AS DOUBLE) AS withdrawals,
  CAST(sum(CASE WHEN type IS DISTINCT FROM 'Charges' THEN amount END) AS DOUBLE) AS ex_charges,
  count(CASE WHEN type = 'Charges' THEN 1 END) AS n_charges
FROM movements GROUP BY currency""", "movements"))
def f07(t):
    ty = F.col("type")
    return B.movements(t).groupBy("currency").agg(
        F.sum(F.when(ty.eqNullSafe("Deposit"), F.col("amount"))).cast("double").alias("deposits"),
        F.abs(F.sum(F.when(ty.eqNullSafe("Withdraw"), F.col("amount")))).cast("double").alias("withdrawals"),
        F.sum(F.when(~ty.eqNullSafe("Charges"), F.col("amount"))).cast("double").alias("ex_charges"),
        F.count_if(ty.eqNullSafe("Charges")).alias("n_charges"))


@query("f08_month_end_filter", sql("""
SELECT date, currency, CAST(sum(closing_balance) AS DOUBLE) AS month_end_closing
FROM ledger WHERE date = last_day(date) GROUP BY date, currency""", "ledger"))
def f08(t):
    me = B.ledger_calendar(t).filter("is_month_end").select(F.col("calendar_date").alias("date"))
    b = ledger(t).join(F.broadcast(me), "date", "left_semi")
    return b.groupBy("date", "currency").agg(F.sum("closing_balance").cast("double").alias("month_end_closing"))


@query("x02_resume_state", sql("""
SELECT a.account_number, (SELECT max(date) FROM w15) + 1 AS resume_date,
       CAST(coalesce(l.closing_balance, 100000.00) AS DOUBLE) AS starting_balance
FROM accounts a LEFT JOIN (SELECT account_number, arg_max(closing_balance, date) AS closing_balance
                           FROM w15 GROUP BY account_number) l ON l.account_number = a.account_number
""", "accounts", "w15"))
def x02(t):
    """Resume from the last stored closing of each account (its own latest
    row), else the default; the run restarts the day after the high-water
    mark (X01)."""
    b = w15(t)
    hwm = b.agg(F.max("date")).scalar()
    last = b.groupBy("account_number").agg(F.max_by("closing_balance", "date").alias("_c"))
    j = B.accounts(t).join(last, "account_number", "left")
    return j.select("account_number", F.date_add(hwm, 1).alias("resume_date"),
                    F.coalesce(F.col("_c"), F.lit(LG.DEFAULT_OPENING).cast("decimal(18,2)")).cast("double")
                    .alias("starting_balance"))
