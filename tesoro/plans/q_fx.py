"""FX history queries: normalisation, keep-last merge, grid, fill, flags,
gap plan, late correction, conversion, pivot.

Rate sources (bindings): every lineitem line quotes its supplier nation's
currency on its ship date at price / quantity / 1000.  Lines are split by
return flag into the three sources of the reference, in precedence order:
stored database (A), stored CSV (N), freshly fetched (R).  Stored rows of
open lines carry the provisional ``filled`` flag.  Each source is given the
messy shape the normaliser exists for (padded/upper-case headers, text
dates, lower-case padded codes, upper-case flags, a missing flag column).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tesoro.operators import calendar as C
from tesoro.operators import fx as FX
from tesoro.plans import bindings as B
from tesoro.plans.oracle_ctes import cte, sql
from tesoro.plans.registry import query

SEQ = ["l_orderkey", "l_linenumber", "l_partkey"]
BASE = B.BASE_CURRENCY


# --- bindings -----------------------------------------------------------------

def rate_lines(t):
    def build():
        li = t("lineitem").select(*SEQ, "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
                                  "l_linestatus", "l_shipdate")
        s = t("supplier").select("s_suppkey", "s_nationkey")
        n = t("nation").select("n_nationkey", "n_name")
        j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        return j.select(F.to_date("l_shipdate").alias("date"), F.col("n_name").alias("currency"),
                        (F.col("l_extendedprice") / F.col("l_quantity") / F.lit(1000)).alias("rate"),
                        "l_returnflag", "l_linestatus", *SEQ)
    return t.memo("rate_lines", build)


def src_db(t):
    r = rate_lines(t).filter(F.col("l_returnflag") == "A")
    return r.select(F.col("date").alias(" Date "), F.col("currency").alias("CURRENCY"),
                    F.col("rate").alias("FX_to_USD"),
                    F.when(F.col("l_linestatus") == "O", "filled").otherwise("raw").alias("fx_quality_flag "),
                    *SEQ)


def src_csv(t):
    r = rate_lines(t).filter(F.col("l_returnflag") == "N")
    return r.select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                    F.concat(F.lit(" "), F.lower("currency"), F.lit(" ")).alias("Currency"),
                    F.col("rate").cast("string").alias("fx_to_usd"),
                    F.when(F.col("l_linestatus") == "O", "FILLED").otherwise("Raw").alias("FX_Quality_Flag"),
                    *SEQ)


def src_fetched(t):
    r = rate_lines(t).filter(F.col("l_returnflag") == "R")
    return r.select("date", "currency", F.col("rate").alias("fx_to_usd"), *SEQ)


def currencies(t):
    return t("nation").select(F.col("n_name").alias("currency"))


def norm(t, df):
    return FX.normalise_fx_frame(df, currencies(t), keep=SEQ)


def fx_bounds(t):
    return t.memo("fx_bounds", lambda: C.date_bounds(rate_lines(t), "date"))


def fx_calendar(t):
    def build():
        lo, hi = fx_bounds(t)
        return C.build_calendar(t.spark, lo, hi)
    return t.memo("fx_calendar", build)


SOURCES = ("db", "csv", "fetched")


def all_sources(t):
    """The three sources in one frame, each row in its source's own shape
    (headers are one thing here: they belong to a frame) with its rank, so
    that merging them reads the lines once."""
    flag = F.col("l_returnflag")
    is_csv, is_open = flag == "N", F.col("l_linestatus") == "O"
    return rate_lines(t).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(is_csv, F.concat(F.lit(" "), F.lower("currency"), F.lit(" "))).otherwise(F.col("currency")).alias("Currency"),
        F.col("rate").cast("string").alias("fx_to_usd"),
        F.when(flag == "A", F.when(is_open, "filled").otherwise("raw")).when(is_csv, F.when(is_open, "FILLED").otherwise("Raw")).alias("FX_Quality_Flag"),
        F.when(flag == "A", 0).when(is_csv, 1).when(flag == "R", 2).alias("_src"), *SEQ).filter("_src IS NOT NULL")


def merged(t, sources=SOURCES):
    ranks = [SOURCES.index(s) for s in sources]
    rows = FX.normalise_fx_frame(all_sources(t).filter(F.col("_src").isin(ranks)), currencies(t), keep=[*SEQ, "_src"])
    return FX.keep_last(rows, ["date", "currency"], ["_src", *SEQ], ["fx_to_usd", "fx_quality_flag"])


def dirty(t):
    """The CSV source with the faults the normaliser exists for, placed by
    the lines' own keys: text that is no date or number, an unknown flag, a
    missing flag, no currency, a currency that is not asked for."""
    k = F.col("l_orderkey")
    return src_csv(t).select(
        F.when(k % 11 == 0, "not a date").otherwise(F.col("date")).alias("date"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, " xxx").otherwise(F.col("Currency")).alias("Currency"),
        F.when(k % 7 == 0, "n/a").otherwise(F.col("fx_to_usd")).alias("fx_to_usd"),
        F.when(k % 5 == 0, "Guessed").when(k % 19 == 0, F.lit(None)).otherwise(F.col("FX_Quality_Flag")).alias("FX_Quality_Flag"), *SEQ)


def history(t):
    def build():
        lo, hi = fx_bounds(t)
        return FX.fill_history(FX.currency_grid(currencies(t), lo, hi), merged(t), BASE)
    return t.memo("fx_history", build)


def stored(t):
    """What the store held before this run: DB + CSV merged (no fill)."""
    return t.memo("fx_stored", lambda: merged(t, ("db", "csv")))


# --- oracle CTEs ------------------------------------------------------------

cte("rate_lines", """
SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS currency,
       l.l_extendedprice / l.l_quantity / 1000 AS rate, l.l_returnflag, l.l_linestatus,
       l.l_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
""")

cte("rate_src", """
SELECT date, currency, rate AS fx_to_usd, l_orderkey, l_linenumber, l_partkey,
       CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS src,
       CASE WHEN l_returnflag = 'R' THEN 'raw' WHEN l_linestatus = 'O' THEN 'filled' ELSE 'raw' END AS fx_quality_flag
FROM rate_lines
""", "rate_lines")

cte("rate_dirty", """
SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE date END AS date,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN 'XXX' ELSE currency END AS currency,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE fx_to_usd END AS fx_to_usd,
       CASE WHEN l_orderkey % 5 = 0 OR l_orderkey % 19 = 0 THEN 'raw' ELSE fx_quality_flag END AS fx_quality_flag
FROM rate_src WHERE src = 1
""", "rate_src")

cte("fx_merged", """
SELECT date, currency, src, fx_to_usd, fx_quality_flag FROM rate_src
QUALIFY row_number() OVER (PARTITION BY date, currency ORDER BY src DESC, l_orderkey DESC, l_linenumber DESC,
                           l_partkey DESC, fx_to_usd DESC, fx_quality_flag DESC) = 1
""", "rate_src")

cte("fx_stored", """
SELECT date, currency, fx_to_usd, fx_quality_flag FROM rate_src WHERE src < 2
QUALIFY row_number() OVER (PARTITION BY date, currency ORDER BY src DESC, l_orderkey DESC, l_linenumber DESC,
                           l_partkey DESC, fx_to_usd DESC, fx_quality_flag DESC) = 1
""", "rate_src")

cte("fx_bounds", "SELECT min(date) AS lo, max(date) AS hi FROM rate_lines", "rate_lines")

cte("fx_grid", """
SELECT n.n_name AS currency, CAST(g.d AS DATE) AS date
FROM nation n, fx_bounds, generate_series(CAST(fx_bounds.lo AS TIMESTAMP), CAST(fx_bounds.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)
""", "fx_bounds")

cte("fx_joined", f"""
SELECT g.date, g.currency, m.fx_to_usd AS raw_rate, m.fx_quality_flag AS flag, m.fx_to_usd IS NULL AS missing,
       CASE WHEN g.currency = '{BASE}' THEN 1.0 ELSE m.fx_to_usd END AS based
FROM fx_grid g LEFT JOIN fx_merged m ON m.date = g.date AND m.currency = g.currency
""", "fx_grid", "fx_merged")

cte("fx_history", f"""
SELECT date, currency, fx_to_usd,
       CASE WHEN currency = '{BASE}' THEN 'raw' WHEN missing AND fx_to_usd IS NOT NULL THEN 'filled'
            ELSE coalesce(flag, 'raw') END AS fx_quality_flag,
       missing AS missing_before_fill
FROM (SELECT *, coalesce(
        last_value(based IGNORE NULLS) OVER (PARTITION BY currency ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(based IGNORE NULLS) OVER (PARTITION BY currency ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fx_to_usd
      FROM fx_joined)
""", "fx_joined")

cte("fx_bdays", """
SELECT CAST(g.d AS DATE) AS date FROM fx_bounds,
  generate_series(CAST(fx_bounds.lo AS TIMESTAMP), CAST(fx_bounds.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)
WHERE isodow(CAST(g.d AS DATE)) <= 5
""", "fx_bounds")

cte("fx_missing", """
SELECT b.date, n.n_name AS currency FROM fx_bdays b, nation n
WHERE NOT EXISTS (SELECT 1 FROM fx_stored s WHERE s.date = b.date AND s.currency = n.n_name)
""", "fx_bdays", "fx_stored")


def _f(*cols):
    return [F.col(c) for c in cols]


# --- queries ------------------------------------------------------------------

@query("p01_normalise_headers", sql("""
SELECT date, currency, fx_to_usd, fx_quality_flag, l_orderkey, l_linenumber, l_partkey
FROM rate_src WHERE src = 0
""", "rate_src"))
def p01(t):
    """The DB source's headers (' Date ', 'CURRENCY', 'FX_to_USD', …)
    stripped and lower-cased."""
    return FX.normalise_headers(src_db(t))


@query("p02_add_missing_columns", sql("""
SELECT date, currency, fx_to_usd, CAST(NULL AS VARCHAR) AS fx_quality_flag FROM rate_src WHERE src = 2
""", "rate_src"))
def p02(t):
    """The fetched source has no flag column: it is added as a typed NULL and
    the required columns are projected in fixed order."""
    return FX.add_missing_columns(src_fetched(t), FX.FX_TYPES).select(*FX.FX_COLUMNS)


@query("p03_lenient_cast", sql("SELECT date, fx_to_usd FROM rate_dirty", "rate_dirty"))
def p03(t):
    """CSV text dates and numbers parsed leniently (bad text → NULL)."""
    c = FX.normalise_headers(dirty(t))
    return c.select(FX.lenient_date(F.col("date")).alias("date"), FX.lenient_double(F.col("fx_to_usd")).alias("fx_to_usd"))


@query("p04_canonicalise_key", sql("""
SELECT currency, count(*) AS n FROM rate_src WHERE src = 1 GROUP BY currency
""", "rate_src"))
def p04(t):
    c = FX.normalise_headers(src_csv(t))
    return c.groupBy(FX.canonical_key(F.col("currency")).alias("currency")).agg(F.count(F.lit(1)).alias("n"))


@query("p05_enum_whitelist_default", sql("""
SELECT fx_quality_flag, count(*) AS n FROM rate_dirty GROUP BY fx_quality_flag
""", "rate_dirty"))
def p05(t):
    """Flags that are unknown or missing count as raw."""
    c = FX.normalise_headers(dirty(t))
    return c.groupBy(FX.whitelist_flag(F.col("fx_quality_flag")).alias("fx_quality_flag")).agg(
        F.count(F.lit(1)).alias("n"))


@query("f01_drop_null_keys", sql("""
SELECT count(*) AS kept_rows, (SELECT count(*) FROM rate_dirty) AS all_rows
FROM rate_dirty WHERE date IS NOT NULL AND currency IS NOT NULL
""", "rate_dirty"))
def f01(t):
    """Rows without a date or currency go."""
    rows = dirty(t)
    kept = FX.normalise_fx_frame(rows, None)
    return kept.agg(F.count(F.lit(1)).alias("kept_rows")).select("kept_rows", rows.agg(F.count(F.lit(1))).scalar().alias("all_rows"))


@query("f02_in_list_filter", sql("""
SELECT currency, count(*) AS n FROM rate_dirty
WHERE date IS NOT NULL AND currency IN (SELECT n_name FROM nation) GROUP BY currency
""", "rate_dirty"))
def f02(t):
    """Rows of currencies that are not in the target list go."""
    return norm(t, dirty(t)).groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


@query("w03_dedup_keep_last", sql("""
SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_merged
""", "fx_merged"))
def w03(t):
    return merged(t)


@query("j18_source_precedence_merge", sql("""
SELECT src AS source_rank, count(*) AS winning_keys FROM fx_merged GROUP BY src
""", "fx_merged"))
def j18(t):
    """Which source wins how many (date, currency) keys (later source wins)."""
    srcs = [norm(t, f(t)).withColumn("_src", F.lit(i)) for i, f in enumerate((src_db, src_csv, src_fetched))]
    u = srcs[0].unionByName(srcs[1]).unionByName(srcs[2])
    last = FX.keep_last(u, ["date", "currency"], ["_src", *SEQ], ["_src", "fx_to_usd", "fx_quality_flag"])
    return last.groupBy(F.col("_src").alias("source_rank")).agg(F.count(F.lit(1)).alias("winning_keys"))


@query("j06_grid_cross_join", sql("""
SELECT currency, count(*) AS days, min(date) AS first_date, max(date) AS last_date FROM fx_grid GROUP BY currency
""", "fx_grid"))
def j06(t):
    lo, hi = fx_bounds(t)
    g = FX.currency_grid(currencies(t), lo, hi)
    return g.groupBy("currency").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_date"),
                                     F.max("date").alias("last_date"))


@query("j07_grid_left_join", sql("""
SELECT date, currency, raw_rate AS fx_to_usd FROM fx_joined
""", "fx_joined"))
def j07(t):
    lo, hi = fx_bounds(t)
    return (FX.currency_grid(currencies(t), lo, hi).join(merged(t), ["date", "currency"], "left")
            .select("date", "currency", "fx_to_usd"))


@query("w01_forward_fill", sql("""
SELECT date, currency, last_value(raw_rate IGNORE NULLS) OVER (PARTITION BY currency ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fx_ffill FROM fx_joined
""", "fx_joined"))
def w01(t):
    lo, hi = fx_bounds(t)
    j = FX.currency_grid(currencies(t), lo, hi).join(merged(t), ["date", "currency"], "left")
    w = Window.partitionBy("currency").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return j.select("date", "currency", F.last("fx_to_usd", ignorenulls=True).over(w).alias("fx_ffill"))


@query("w02_backward_fill", sql("""
SELECT date, currency, first_value(raw_rate IGNORE NULLS) OVER (PARTITION BY currency ORDER BY date
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fx_bfill FROM fx_joined
""", "fx_joined"))
def w02(t):
    """Back-fill within each currency only (Trap2: never borrow another
    currency's rate)."""
    lo, hi = fx_bounds(t)
    j = FX.currency_grid(currencies(t), lo, hi).join(merged(t), ["date", "currency"], "left")
    w = Window.partitionBy("currency").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    return j.select("date", "currency", F.first("fx_to_usd", ignorenulls=True).over(w).alias("fx_bfill"))


@query("p11_case_constant_currency", sql(f"""
SELECT date, fx_to_usd, fx_quality_flag FROM fx_history WHERE currency = '{BASE}'
""", "fx_history"))
def p11(t):
    return history(t).filter(F.col("currency") == BASE).select("date", "fx_to_usd", "fx_quality_flag")


@query("d03_fx_history", sql("""
SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_history
""", "fx_history"))
def d03(t):
    return history(t).select(*FX.FX_COLUMNS)


@query("a17_null_count_by_key", sql("""
SELECT currency, count_if(missing_before_fill) AS missing_before_fill, count_if(fx_to_usd IS NULL) AS missing_after_fill
FROM fx_history WHERE isodow(date) <= 5 GROUP BY currency
""", "fx_history"))
def a17(t):
    return FX.missing_on_business_days(history(t), fx_calendar(t))


@query("q01_no_missing_after_fill", sql("""
SELECT count(*) AS currencies_checked, count_if(missing_after_fill > 0) AS currencies_failing,
       count_if(missing_after_fill > 0) = 0 AS passed
FROM (SELECT currency, count_if(fx_to_usd IS NULL) AS missing_after_fill FROM fx_history
      WHERE isodow(date) <= 5 GROUP BY currency)
""", "fx_history"))
def q01(t):
    m = FX.missing_on_business_days(history(t), fx_calendar(t))
    return m.agg(F.count(F.lit(1)).alias("currencies_checked"),
                  F.count_if(F.col("missing_after_fill") > 0).alias("currencies_failing")).withColumn(
        "passed", F.col("currencies_failing") == 0)


@query("j04_missing_grid_anti_join", sql("SELECT date, currency FROM fx_missing", "fx_missing"))
def j04(t):
    lo, hi = fx_bounds(t)
    return FX.missing_grid(stored(t), currencies(t), fx_calendar(t), lo, hi)


@query("u02_set_difference", sql("SELECT date, currency FROM fx_missing", "fx_missing"))
def u02(t):
    """The same difference with set semantics: expected keys EXCEPT present."""
    lo, hi = fx_bounds(t)
    bd = fx_calendar(t).filter("is_business_day").select(F.col("calendar_date").alias("date"))
    expected = FX.currency_grid(currencies(t), lo, hi).join(F.broadcast(bd), "date", "left_semi")
    return expected.select("date", "currency").subtract(stored(t).select("date", "currency"))


@query("f04_recent_flagged_lookback", sql("""
SELECT DISTINCT date FROM fx_stored WHERE fx_quality_flag = 'filled' AND date >= (SELECT hi FROM fx_bounds) - 7
""", "fx_stored", "fx_bounds"))
def f04(t):
    lo, hi = fx_bounds(t)
    return FX.recent_filled_dates(stored(t), hi)


@query("d04_fx_gap_plan", sql("""
SELECT (SELECT max(date) FROM fx_stored) AS latest_date,
       (SELECT min(date) FROM fx_missing) AS first_missing_business_day,
       (SELECT count(*) FROM fx_missing) AS missing_rows,
       (SELECT min(date) FROM fx_stored WHERE fx_quality_flag = 'filled' AND date >= (SELECT hi FROM fx_bounds) - 7) AS first_recent_filled,
       (SELECT count(DISTINCT date) FROM fx_stored WHERE fx_quality_flag = 'filled' AND date >= (SELECT hi FROM fx_bounds) - 7) AS recent_filled_days,
       least((SELECT max(date) FROM fx_stored) + 1,
             (SELECT min(date) FROM fx_missing),
             (SELECT min(date) FROM fx_stored WHERE fx_quality_flag = 'filled' AND date >= (SELECT hi FROM fx_bounds) - 7)) AS fetch_start
""", "fx_stored", "fx_missing", "fx_bounds"))
def d04(t):
    lo, hi = fx_bounds(t)
    return FX.gap_plan(stored(t), currencies(t), fx_calendar(t), lo, hi)


@query("x05_late_correction", sql("""
SELECT s.date, s.currency, coalesce(f.fx_to_usd, s.fx_to_usd) AS fx_to_usd,
       CASE WHEN f.fx_to_usd IS NOT NULL THEN 'raw' ELSE s.fx_quality_flag END AS fx_quality_flag
FROM fx_stored s LEFT JOIN (SELECT date, currency, fx_to_usd FROM rate_src WHERE src = 2
                            QUALIFY row_number() OVER (PARTITION BY date, currency ORDER BY l_orderkey DESC, l_linenumber DESC,
                                                       l_partkey DESC, fx_to_usd DESC) = 1) f
  ON f.date = s.date AND f.currency = s.currency
 AND s.fx_quality_flag = 'filled' AND s.date >= (SELECT hi FROM fx_bounds) - 7
""", "fx_stored", "rate_src", "fx_bounds"))
def x05(t):
    """Provisional (``filled``) stored rows of the last 7 days that the
    fetched source now covers take the new value and become raw.  The
    corrections are written back by keyed upsert (K05) into a versioned table,
    twice: a repeated run changes nothing.  Returns the stored table
    afterwards."""
    from tesoro.session import scratch_path
    from tesoro.sinks.versioned import VersionedTable
    lo, hi = fx_bounds(t)
    period = F.date_format("date", "yyyy-MM").alias("period")
    table = VersionedTable(t.spark, scratch_path(t.spark, "x05"), "period")
    table.upsert(stored(t).select("*", period), ["date", "currency"])
    for _ in range(2):
        fixes = FX.late_corrections(table.read(), merged(t, ("fetched",)), hi)
        table.upsert(fixes.select("*", period), ["date", "currency"])
    return table.read().select(*FX.FX_COLUMNS)


# one column per currency of the driver tables' nation table (25 codes)
NATIONS = [f"NATION_{i}" for i in range(25)]


@query("a16_pivot_rates", sql("""
SELECT date, """ + ", ".join(f"max(CASE WHEN currency = '{c}' THEN fx_to_usd END) AS {c}" for c in NATIONS) + """
FROM fx_history GROUP BY date
""", "fx_history"))
def a16(t):
    """Long → wide: one column per currency.  The pivot values come from the
    currency dimension (a bounded list), so Spark needs no extra pass to
    discover them."""
    codes = sorted(r[0] for r in currencies(t).collect())  # dimension: one row per currency
    return history(t).groupBy("date").pivot("currency", codes).agg(F.first("fx_to_usd"))


@query("s11_typed_import_with_derived", sql("""
SELECT date, currency, fx_to_usd, CASE WHEN fx_to_usd = 0 THEN NULL ELSE 1.0 / fx_to_usd END AS fx_rate FROM fx_history
""", "fx_history"))
def s11(t):
    h = history(t)
    return h.select("date", "currency", "fx_to_usd",
                    F.try_divide(F.lit(1.0), F.col("fx_to_usd")).alias("fx_rate"))


@query("j12_fx_conversion_join", sql("""
SELECT m.date, m.transaction_id, m.account_number, CAST(m.amount AS DOUBLE) / h.fx_to_usd AS amount_usd
FROM movements m LEFT JOIN fx_history h ON h.date = m.date AND h.currency = m.currency
""", "movements", "fx_history"))
def j12(t):
    mv = B.movements(t).select("date", "transaction_id", "account_number", "currency", "amount")
    return FX.convert_to_usd(mv, history(t), "amount", "amount_usd").select(
        "date", "transaction_id", "account_number", "amount_usd")


@query("a10_sum_of_products", sql("""
SELECT m.date, round(sum(CAST(m.amount AS DOUBLE) * (1.0 / h.fx_to_usd)), 4) AS movements_usd
FROM movements m LEFT JOIN fx_history h ON h.date = m.date AND h.currency = m.currency GROUP BY m.date
""", "movements", "fx_history"))
def a10(t):
    """Σ(amount × fx_rate) per date, fx_rate = 1 / fx_to_usd (S11); USD
    shown to 4 decimals (a double sum's last bits depend on the order)."""
    mv = B.movements(t).select("date", "currency", "amount")
    r = history(t).select("date", "currency", F.try_divide(F.lit(1.0), F.col("fx_to_usd")).alias("fx_rate"))
    j = mv.join(r, ["date", "currency"], "left")
    return j.groupBy("date").agg(F.round(F.sum(F.col("amount").cast("double") * F.col("fx_rate")), 4)
                                 .alias("movements_usd"))
