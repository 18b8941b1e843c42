"""DuckDB restatements of the bindings, as named CTEs.

Each CTE is written independently of the Spark code, in the most direct SQL
form (e.g. exposure by an explicit range join over the calendar rather
than the delta form), so the oracle checks the Spark plan rather than
mirroring it.  ``sql(body, *needs)`` prepends the CTEs a query needs, in
dependency order.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}
RECURSIVE: set[str] = set()


def cte(name: str, body: str, *deps: str, recursive: bool = False) -> None:
    CTES[name] = (body.strip(), deps)
    if recursive:
        RECURSIVE.add(name)


class LazySQL:
    """Oracle SQL whose CTEs are resolved when rendered, so query modules
    may use CTEs registered by modules imported after them."""

    def __init__(self, body: str, needs: tuple[str, ...]):
        self.body, self.needs = body, needs

    def __str__(self) -> str:
        return render(self.body, *self.needs)


def sql(body: str, *needs: str) -> LazySQL:
    return LazySQL(body, needs)


def render(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    # read by several others: computed once (a recursive one decides for itself)
    parts = [f"{n} AS {'' if n in RECURSIVE else 'MATERIALIZED '}(\n{CTES[n][0]}\n)" for n in order]
    head = "WITH RECURSIVE " if RECURSIVE.intersection(order) else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()


# --- FX collateral star -----------------------------------------------------

cte("legs", """
SELECT c.c_mktsegment AS bank_id,
       l.l_orderkey AS trade_id,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey,
            l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
            l.l_linestatus, l.l_shipdate) AS INTEGER) AS leg_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'spot' WHEN 'O' THEN 'forward' WHEN 'P' THEN 'swap' END AS type,
       CAST(o.o_orderdate AS DATE) AS trade_date,
       CAST(o.o_orderdate AS DATE) + CAST(1 + l.l_partkey % 30 AS INTEGER) AS value_date,
       l.l_returnflag AS currency_pair,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS trade_size_usd,
       CAST(l.l_discount - l.l_tax AS DECIMAL(6,4)) AS step_rate
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
""")

cte("bounds", "SELECT min(trade_date) AS lo, max(value_date) AS hi FROM legs", "legs")

cte("cal", """
SELECT CAST(g.d AS DATE) AS calendar_date
FROM bounds, generate_series(CAST(bounds.lo AS TIMESTAMP), CAST(bounds.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)
""", "bounds")

cte("bdays", "SELECT calendar_date AS report_date FROM cal WHERE isodow(calendar_date) <= 5", "cal")

cte("cal_end", "SELECT max(report_date) AS end_date FROM bdays", "bdays")

cte("exposure", """
SELECT l.bank_id, b.report_date, sum(l.trade_size_usd) AS exposure, count(*) AS active_legs
FROM legs l JOIN bdays b ON b.report_date >= l.trade_date AND b.report_date < l.value_date
GROUP BY l.bank_id, b.report_date
""", "legs", "bdays")

cte("review_dates", """
SELECT make_date(CAST(y.y AS BIGINT), CAST(m.m AS BIGINT), 1) AS review_date
FROM bounds, range(year(bounds.lo), year(bounds.hi) + 1) y(y), (VALUES (1), (7)) m(m)
WHERE make_date(CAST(y.y AS BIGINT), CAST(m.m AS BIGINT), 1) <= bounds.hi
""", "bounds")

cte("reviews", """
SELECT bank_id, review_date, effective_date FROM (
  SELECT b.bank_id, r.review_date,
         coalesce((SELECT min(report_date) FROM bdays WHERE report_date >= r.review_date),
                  (SELECT max(report_date) FROM bdays)) AS effective_date
  FROM (SELECT DISTINCT c_mktsegment AS bank_id FROM customer) b, review_dates r)
QUALIFY row_number() OVER (PARTITION BY bank_id, effective_date ORDER BY review_date DESC) = 1
""", "review_dates", "bdays")

cte("sched", """
SELECT r.bank_id, r.effective_date, d.report_date AS as_of_date
FROM (SELECT bank_id, effective_date,
             lead(effective_date) OVER (PARTITION BY bank_id ORDER BY effective_date) AS valid_to
      FROM reviews) r
JOIN bdays d ON d.report_date >= r.effective_date
            AND (r.valid_to IS NULL OR d.report_date < r.valid_to)
""", "reviews", "bdays")

cte("review_limits", """
SELECT r.bank_id, r.review_date, r.effective_date,
       CAST(greatest(round(1.2 * coalesce(m.mean, 0.0) / 250000.0) * 250000.0, 250000.0) AS DOUBLE) AS credit_limit_usd
FROM reviews r
LEFT JOIN (SELECT s.bank_id, s.effective_date, avg(CAST(e.exposure AS DOUBLE)) AS mean
           FROM sched s JOIN exposure e ON e.bank_id = s.bank_id AND e.report_date = s.as_of_date
           GROUP BY s.bank_id, s.effective_date) m
  ON m.bank_id = r.bank_id AND m.effective_date = r.effective_date
""", "reviews", "sched", "exposure")

cte("limits", """
SELECT s.as_of_date, s.bank_id, rl.credit_limit_usd,
       CAST(coalesce(e.exposure, 0) AS DOUBLE) AS counterparty_exposure_usd,
       CAST(CAST(rl.credit_limit_usd AS DECIMAL(18,2)) - coalesce(e.exposure, 0) AS DOUBLE) AS limit_available_usd,
       coalesce(CAST(coalesce(e.exposure, 0) AS DOUBLE) / nullif(rl.credit_limit_usd, 0), 0.0) AS utilisation
FROM sched s
JOIN review_limits rl ON rl.bank_id = s.bank_id AND rl.effective_date = s.effective_date
LEFT JOIN exposure e ON e.bank_id = s.bank_id AND e.report_date = s.as_of_date
""", "sched", "review_limits", "exposure")
