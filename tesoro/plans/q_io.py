"""Sources, sinks, incremental loads, quality gates and the daily-file
stream.  Every query lands data that Spark derives from the driver tables
in a fresh folder under ``spark.checkpoint.dir`` and reads it back, so the
whole write → read path is exercised at the tables' full size."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tesoro.operators import fx as FX
from tesoro.operators import quality as Q
from tesoro.plans import bindings as B
from tesoro.plans import q_fx as QF
from tesoro.plans.oracle_ctes import sql
from tesoro.plans.q_collateral import collateral, trade_mtm
from tesoro.plans.q_positions import limits, portfolio
from tesoro.plans.q_treasury import ledger, sweeps
from tesoro.plans.registry import query
from tesoro.session import scratch_path, staged
from tesoro.sinks import writers as K
from tesoro.sinks.keyed import KeyedTable
from tesoro.sinks.versioned import VersionedTable
from tesoro.sources import readers as S
from tesoro.streaming.daily_files import daily_file_stream
from tesoro.streaming.ledger_store import LedgerStore, ledger_stream

MOV_DDL = ("date date, transaction_id string, account_number string, currency string, type string, "
           "category string, amount decimal(18,2), description string")
BAL_DDL = ("account_number string, currency string, starting_balance decimal(18,2), "
           "total_movements decimal(18,2), sweep_amount decimal(18,2), closing_balance decimal(18,2)")
FX_DDL = "date date, currency string, fx_to_usd double, fx_quality_flag string"
MTM_DDL = "report_date date, trade_id bigint, bank_id string, mtm double, pnl double, trade_size_usd double"


def landed(t, key: str, write):
    """Write once per loader and remember the folder."""
    def build():
        path = scratch_path(t.spark, key)
        write(path)
        return path
    return t.memo(f"landed_{key}", build)


def movements_csv(t):
    return landed(t, "movements-csv", lambda p: K.csv_overwrite(B.movements(t), p))


def ledger_days(t):
    return landed(t, "ledger-days", lambda p: K.per_day_partition_write(ledger(t), p, "date"))


def fx_table(t):
    return landed(t, "fx-history", lambda p: QF.history(t).select(*FX.FX_COLUMNS).write.parquet(p))


def mtm_cut(t) -> dt.date:
    """The previous run's date used by the incremental examples: 60 days
    before the report horizon (a run parameter, not a row filter)."""
    return B.calendar_end(t) - dt.timedelta(days=60)


def versioned(t, name: str, partition_col: str | None = None) -> VersionedTable:
    return VersionedTable(t.spark, scratch_path(t.spark, name), partition_col)


def _dbl(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


# --- sources -----------------------------------------------------------------

@query("s01_csv_scan", sql("""
SELECT date, transaction_id, account_number, currency, type, category, CAST(amount AS DOUBLE) AS amount, description
FROM movements""", "movements"))
def s01(t):
    return _dbl(S.csv_scan(t.spark, movements_csv(t), MOV_DDL), "amount")


@query("s02_csv_scan_pruned", sql("""
SELECT account_number, CAST(sum(amount) AS DOUBLE) AS total FROM movements GROUP BY account_number
""", "movements"))
def s02(t):
    df = S.csv_scan_pruned(t.spark, movements_csv(t), MOV_DDL, ["account_number", "amount"])
    return df.groupBy("account_number").agg(F.sum("amount").cast("double").alias("total"))


@query("k01_csv_overwrite", sql("SELECT type, count(*) AS n FROM movements GROUP BY type", "movements"))
def k01(t):
    """Overwrite twice: the second write replaces the first entirely."""
    p = scratch_path(t.spark, "k01")
    K.csv_overwrite(B.movements(t), p)
    K.csv_overwrite(B.movements(t), p)
    return S.csv_scan(t.spark, p, MOV_DDL).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("s03_dated_directory_scan", sql("""
SELECT date AS file_date, account_number, CAST(closing_balance AS DOUBLE) AS closing_balance FROM ledger
WHERE date IN (SELECT DISTINCT date FROM ledger ORDER BY date DESC LIMIT 5)""", "ledger"))
def s03(t):
    """The last five day-folders of the per-day balance files, the date
    taken from each file's path."""
    df = S.dated_directory_scan(t.spark, ledger_days(t), BAL_DDL, r"date=(\d{4}-\d{2}-\d{2})",
                                last_n=5, reader="parquet")
    return _dbl(df.select("file_date", "account_number", "closing_balance"), "closing_balance")


@query("k03_per_day_partition_write", sql("""
SELECT date, count(*) AS n, CAST(sum(closing_balance) AS DOUBLE) AS closing FROM ledger GROUP BY date""", "ledger"))
def k03(t):
    df = t.spark.read.parquet(ledger_days(t))
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("closing_balance").cast("double").alias("closing"))


def per_account_row(led, accounts):
    """The ledger joined with its own accounts where no column of theirs is
    asked for: a row comes once for each row of its account, and the ledger has
    no other accounts.  Only those that stand more than once are met, so the
    accounts x days are not shuffled for it."""
    again = staged(accounts.groupBy("account_number").agg(F.count(F.lit(1)).cast("int").alias("_times")).filter("_times > 1"), "repeated-accounts")
    j = led.filter(F.col("account_number").isNotNull()).join(again, "account_number", "left")
    return j.withColumn("_time", F.explode(F.sequence(F.lit(1), F.coalesce("_times", F.lit(1))))).drop("_times", "_time")


WIDE = ["bank_id", "bank_name", "account_number", "currency", "starting_balance", "total_movements",
        "closing_balance", "date"]
BAL_TYPES = {"bank_id": "string", "bank_name": "string", "account_number": "string", "currency": "string",
             "starting_balance": "decimal(18,2)", "total_movements": "decimal(18,2)",
             "closing_balance": "decimal(18,2)", "date": "date"}


@query("s04_drifted_schema_scan", sql("""
SELECT a.bank_id, a.bank_name, l.account_number, l.currency, CAST(l.starting_balance AS DOUBLE) AS starting_balance,
       CAST(l.total_movements AS DOUBLE) AS total_movements, CAST(l.closing_balance AS DOUBLE) AS closing_balance, l.date
FROM ledger l JOIN accounts a ON a.account_number = l.account_number""", "ledger", "accounts"))
def s04(t):
    """Balance files in two shapes (Trap13): the first day of each month
    carries bank_id/bank_name, other days do not.  Read together, aligned
    by name, bank columns back-filled from the account dimension.

    The account dimension is staged: of a file the planner knows the size, of
    the accounts' own joins only the product of theirs, which has it shuffle
    the accounts x days on both ways."""
    dim = t.memo("account_dimension", lambda: staged(B.accounts(t), "account-dimension"))

    def write(p):
        led, first = ledger(t), F.dayofmonth("date") == 1
        K.csv_parts(led.filter(first).join(dim.select("account_number", "bank_id", "bank_name"), "account_number").select(*WIDE), f"{p}/wide")
        K.csv_parts(per_account_row(led.filter(~first), dim).select(*[c for c in WIDE if not c.startswith("bank_")]), f"{p}/narrow")
    root = landed(t, "drifted-balances", write)
    df = S.drifted_schema_scan(t.spark, root, BAL_TYPES, dimension=dim, key="account_number", backfill=["bank_id", "bank_name"])
    return _dbl(df, "starting_balance", "total_movements", "closing_balance")


@query("s05_jdbc_table_scan", sql("SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_history", "fx_history"))
def s05(t):
    return S.table_scan(t.spark, {"path": fx_table(t)})


@query("s06_jdbc_query_scan", sql("""
SELECT account_number, CAST(closing_balance AS DOUBLE) AS closing_balance FROM ledger
WHERE date = (SELECT max(date) FROM ledger)""", "ledger"))
def s06(t):
    q = ("SELECT account_number, CAST(closing_balance AS DOUBLE) AS closing_balance FROM treasury_balances "
         "WHERE date = (SELECT MAX(date) FROM treasury_balances)")
    return S.query_scan(t.spark, {"path": ledger_days(t), "view": "treasury_balances"}, q)


@query("s07_nested_json_rates", sql(f"""
SELECT d.date, n.n_name AS currency,
       CASE WHEN n.n_name = '{B.BASE_CURRENCY}' THEN 1.0 ELSE f.fx_to_usd END AS fx_to_usd
FROM (SELECT DISTINCT date FROM rate_src WHERE src = 2) d CROSS JOIN nation n
LEFT JOIN (SELECT date, currency, fx_to_usd FROM rate_src WHERE src = 2
           QUALIFY row_number() OVER (PARTITION BY date, currency ORDER BY l_orderkey DESC, l_linenumber DESC,
                                      l_partkey DESC, fx_to_usd DESC) = 1) f
  ON f.date = d.date AND f.currency = n.n_name
""", "rate_src"))
def s07(t):
    """Fetched quotes landed as monthly JSON documents of the rates API's
    shape, then parsed back into rows."""
    def write(p):
        q = FX.merge_sources([QF.norm(t, QF.src_fetched(t))], QF.SEQ)
        per_day = q.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("currency", "fx_to_usd")))
                                        .alias("quotes"))
        per_month = per_day.groupBy(F.date_format("date", "yyyy-MM").alias("_m")).agg(
            F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), "quotes"))).alias("rates"))
        per_month.select(F.to_json(F.struct("rates")).alias("value")).write.text(p)
    path = landed(t, "rates-json", write)
    codes = sorted(r[0] for r in QF.currencies(t).collect())  # currency dimension (bounded)
    return S.nested_json_rates(t.spark, path, codes, B.BASE_CURRENCY)


@query("s08_static_dimension_load", sql("""
SELECT a.account_number, a.bank_name, count(*) AS n_movements
FROM movements m JOIN accounts a ON a.account_number = m.account_number GROUP BY a.account_number, a.bank_name
""", "movements", "accounts"))
def s08(t):
    p = landed(t, "dim-accounts", lambda p: K.csv_overwrite(B.accounts(t), p))
    dim = S.static_dimension_load(t.spark, p, "bank_id string, bank_name string, account_number string, "
                                              "currency string, opening_balance decimal(18,2)")
    m = B.movements(t).groupBy("account_number").agg(F.count(F.lit(1)).alias("n_movements"))
    return m.join(dim, "account_number").select("account_number", "bank_name", "n_movements")


@query("s09_empty_source_fallback", sql("""
SELECT count(*) AS n_rows, max(date) AS high_water_mark FROM fx_history""", "fx_history"))
def s09(t):
    """A missing CSV copy reads as an empty typed table, so the union with
    the stored table goes ahead (and the mark is still right)."""
    missing = S.read_or_empty(t.spark, scratch_path(t.spark, "never-written"), FX_DDL, "csv")
    stored = S.read_or_empty(t.spark, fx_table(t), FX_DDL)
    u = stored.unionByName(missing)
    return u.agg(F.count(F.lit(1)).alias("n_rows"), F.max("date").alias("high_water_mark"))


@query("s10_dimension_import_filtered", sql("""
SELECT calendar_date FROM cal WHERE calendar_date <= (SELECT max(report_date) FROM coll_report)""", "cal", "coll_report"))
def s10(t):
    return S.dimension_import_filtered(B.trade_calendar(t), collateral(t), "calendar_date", "report_date").select(
        "calendar_date")


# --- sinks ---------------------------------------------------------------------

@query("k02_incremental_append", sql("""
SELECT report_date, count(*) AS n FROM trade_mtm GROUP BY report_date""", "trade_mtm"))
def k02(t):
    """First run writes the history up to the previous run date; the next
    run loads only the days from the mark on.  The mark is part of the version
    that holds its rows (X01)."""
    table = versioned(t, "k02", "report_date")
    m = trade_mtm(t).select("report_date", "trade_id", "bank_id", "mtm", "pnl", "trade_size_usd")
    table.load_newer(m.filter(F.col("report_date") <= F.lit(mtm_cut(t))), "trade_mtm", "report_date")
    table.load_newer(m, "trade_mtm", "report_date")
    table.load_newer(m, "trade_mtm", "report_date")     # a repeated run replaces the mark's own day by itself
    return table.read().groupBy("report_date").agg(F.count(F.lit(1)).alias("n"))


@query("k04_replace_by_date", sql("""
SELECT date, count(*) AS n, CAST(sum(closing_balance) AS DOUBLE) AS closing FROM ledger GROUP BY date""", "ledger"))
def k04(t):
    """Write all days, then replace the last ten days twice: no day gains
    or loses rows (idempotent reruns)."""
    table = versioned(t, "k04", "date")
    led = ledger(t)
    table.replace_partitions(led)
    last = led.agg(F.max("date")).first()[0]
    recent = led.filter(F.col("date") > F.lit(last - dt.timedelta(days=10)))
    table.replace_partitions(recent)
    table.replace_partitions(recent)
    return table.read().groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("closing_balance").cast("double").alias("closing"))


@query("k05_upsert_by_key", sql("SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_merged", "fx_merged"))
def k05(t):
    """Stored rates (DB + CSV) upserted with the fetched rates on
    (date, currency): only touched partitions are rewritten."""
    table = versioned(t, "k05", "period")   # monthly partitions
    period = F.date_format("date", "yyyy-MM").alias("period")
    table.upsert(QF.stored(t).select("*", period), ["date", "currency"])
    fresh = FX.merge_sources([QF.norm(t, QF.src_fetched(t))], QF.SEQ)
    table.upsert(fresh.select("*", period), ["date", "currency"])
    return table.read().select(*FX.FX_COLUMNS)


@query("k05_upsert_keyed", sql("SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_merged", "fx_merged"))
def k05_keyed(t):
    """K05 on a keyed table: fetched rates replace stored ones of the same
    (date, currency); parts whose filters hold no such key are not read."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "k05-keyed"), ["date", "currency"])
    table.upsert(QF.stored(t))
    table.upsert(FX.merge_sources([QF.norm(t, QF.src_fetched(t))], QF.SEQ))
    return table.read().select(*FX.FX_COLUMNS)


def _raw_rates(t):
    srcs = [QF.norm(t, f(t)).withColumn("src", F.lit(i))
            for i, f in enumerate((QF.src_db, QF.src_csv, QF.src_fetched))]
    return srcs[0].unionByName(srcs[1]).unionByName(srcs[2])


@query("k06_delete_legacy_duplicates", sql("SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_merged", "fx_merged"))
def k06(t):
    out = K.keep_last_per_key(_raw_rates(t), ["date", "currency"],
                              ["src", *QF.SEQ, "fx_to_usd", "fx_quality_flag"])
    return out.select(*FX.FX_COLUMNS)


@query("k07_delete_duplicates_self_join", sql("SELECT date, currency, fx_to_usd, fx_quality_flag FROM fx_merged", "fx_merged"))
def k07(t):
    r = _raw_rates(t).withColumn("seq", F.struct("src", *QF.SEQ, "fx_to_usd", "fx_quality_flag"))
    return K.delete_duplicates_anti(r, ["date", "currency"], "seq").select(*FX.FX_COLUMNS).distinct()


@query("k08_key_uniqueness_check", sql("""
SELECT 'ledger' AS dataset, (SELECT count(*) FROM (SELECT date, account_number FROM ledger GROUP BY ALL HAVING count(*) > 1)) AS duplicate_keys
UNION ALL
SELECT 'raw_rates', (SELECT count(*) FROM (SELECT date, currency FROM rate_src GROUP BY ALL HAVING count(*) > 1))
""", "ledger", "rate_src"))
def k08(t):
    a = K.duplicate_keys(ledger(t), ["date", "account_number"]).agg(F.count(F.lit(1)).alias("duplicate_keys"))
    b = K.duplicate_keys(_raw_rates(t), ["date", "currency"]).agg(F.count(F.lit(1)).alias("duplicate_keys"))
    return (a.select(F.lit("ledger").alias("dataset"), "duplicate_keys")
            .unionByName(b.select(F.lit("raw_rates").alias("dataset"), "duplicate_keys")))


@query("k09_create_table_if_absent", sql("""
SELECT currency, count(*) AS n FROM fx_history GROUP BY currency""", "fx_history"))
def k09(t):
    p = scratch_path(t.spark, "k09")
    K.create_table_if_absent(t.spark, p, FX_DDL)
    QF.history(t).select(*FX.FX_COLUMNS).write.mode("append").parquet(p)
    df = K.create_table_if_absent(t.spark, p, FX_DDL)  # second call: data kept
    return df.groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


@query("k10_add_column_with_default", sql("""
SELECT 'raw' AS fx_quality_flag, count(*) AS n FROM fx_history""", "fx_history"))
def k10(t):
    """Rows stored before the flag column existed read back as 'raw'."""
    p = landed(t, "fx-noflag", lambda p: QF.history(t).select("date", "currency", "fx_to_usd").write.parquet(p))
    df = K.add_column_with_default(t.spark.read.parquet(p), "fx_quality_flag", FX.QUALITY_RAW)
    return df.groupBy("fx_quality_flag").agg(F.count(F.lit(1)).alias("n"))


@query("k11_insert_missing_rows", sql("""
SELECT (SELECT count(*) FROM dim_date WHERE calendar_date NOT IN (SELECT trade_date FROM legs)) AS inserted_rows,
       (SELECT count(*) FROM dim_date) AS total_rows""", "dim_date", "legs"))
def k11(t):
    """The stored date table holds only days that had trades; the missing
    calendar days are inserted (anti join + append)."""
    cal = B.trade_calendar(t)
    stored = cal.join(B.legs(t).select(F.col("trade_date").alias("calendar_date")).distinct(), "calendar_date", "left_semi")
    p = scratch_path(t.spark, "k11")
    stored.write.parquet(p)
    missing = K.insert_missing_rows(t.spark.read.parquet(p), cal, ["calendar_date"])
    n = missing.count()
    missing.write.mode("append").parquet(p)
    return t.spark.read.parquet(p).agg(F.lit(n).cast("long").alias("inserted_rows"),
                                       F.count(F.lit(1)).alias("total_rows"))


@query("k12_ordered_export", sql("SELECT date, currency, fx_to_usd FROM fx_history", "fx_history"))
def k12(t):
    table = versioned(t, "k12")
    table.overwrite(QF.history(t).select("date", "currency", "fx_to_usd"), order=["date", "currency"])
    return table.read()


# --- incremental ---------------------------------------------------------------

@query("x01_high_water_mark", sql("SELECT max(report_date) AS high_water_mark FROM trade_mtm", "trade_mtm"))
def x01(t):
    p = landed(t, "trade-mtm", lambda p: trade_mtm(t).write.parquet(p))
    return Q.high_water_mark(S.read_or_empty(t.spark, p, MTM_DDL), "report_date")


@query("x03_independent_watermarks", sql("""
SELECT 'portfolio' AS dataset, (SELECT max(report_date) FROM portfolio) AS high_water_mark
UNION ALL SELECT 'trade_mtm', (SELECT max(report_date) FROM trade_mtm)
UNION ALL SELECT 'limits', (SELECT max(as_of_date) FROM limits)
UNION ALL SELECT 'mtm_report', (SELECT max(report_date) FROM coll_report)
""", "portfolio", "trade_mtm", "limits", "coll_report"))
def x03(t):
    return Q.independent_watermarks({"portfolio": (portfolio(t), "report_date"),
                                     "trade_mtm": (trade_mtm(t), "report_date"),
                                     "limits": (limits(t), "as_of_date"),
                                     "mtm_report": (collateral(t), "report_date")})


@query("x04_incremental_slice", sql("""
SELECT report_date, count(*) AS n FROM trade_mtm
WHERE report_date > (SELECT end_date FROM cal_end) - 60 GROUP BY report_date""", "trade_mtm", "cal_end"))
def x04(t):
    return Q.incremental_slice(trade_mtm(t), "report_date", mtm_cut(t)).groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n"))


@query("f03_newer_than_watermark", sql("""
SELECT date, currency, fx_to_usd FROM fx_merged WHERE date > (SELECT max(date) FROM fx_stored) - 30
""", "fx_merged", "fx_stored"))
def f03(t):
    """Merged rates newer than the stored mark minus 30 days (the window the
    next load rewrites)."""
    mark = QF.stored(t).agg(F.max("date")).first()[0] - dt.timedelta(days=30)
    return Q.incremental_slice(QF.merged(t), "date", mark).select("date", "currency", "fx_to_usd")


# --- quality -------------------------------------------------------------------

@query("q02_not_null_check", sql("""
SELECT 'date' AS "column", count_if(date IS NULL) AS nulls FROM fx_history
UNION ALL SELECT 'currency', count_if(currency IS NULL) FROM fx_history
UNION ALL SELECT 'fx_to_usd', count_if(fx_to_usd IS NULL) FROM fx_history
UNION ALL SELECT 'fx_quality_flag', count_if(fx_quality_flag IS NULL) FROM fx_history
""", "fx_history"))
def q02(t):
    return Q.not_null_check(QF.history(t), FX.FX_COLUMNS)


@query("q03_exposure_within_limit", sql("""
SELECT bank_id, count(*) AS days_over_limit FROM limits
WHERE counterparty_exposure_usd > credit_limit_usd + 0.01 GROUP BY bank_id""", "limits"))
def q03(t):
    return Q.exposure_within_limit(limits(t)).groupBy("bank_id").agg(F.count(F.lit(1)).alias("days_over_limit"))


@query("q05_rerun_idempotent", sql("""
SELECT count(*) AS rows_first_run, count(*) AS rows_second_run, true AS idempotent FROM ledger""", "ledger"))
def q05(t):
    table = versioned(t, "q05", "date")
    table.replace_partitions(ledger(t))
    n1 = table.read().count()
    table.replace_partitions(ledger(t))
    df = table.read()
    return df.agg(F.lit(n1).cast("long").alias("rows_first_run"), F.count(F.lit(1)).alias("rows_second_run")) \
        .withColumn("idempotent", F.col("rows_first_run") == F.col("rows_second_run"))


@query("q06_row_count_check", sql("SELECT 'balances' AS dataset, count(*) AS n_rows FROM ledger", "ledger"))
def q06(t):
    return Q.row_count(t.spark.read.parquet(ledger_days(t)), "balances")


# --- streaming -------------------------------------------------------------------

@query("z01_daily_file_stream", sql("""
SELECT date, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM movements GROUP BY date""", "movements"))
def z01(t):
    """Daily movement files landed as CSV, loaded by a file stream that
    upserts on (date, transaction_id) into a versioned table by month; the
    stream is started twice and the second run finds nothing new
    (checkpointed), so the table is unchanged."""
    landing = movements_csv(t)
    target = versioned(t, "z01-table", "period")
    ckpt = scratch_path(t.spark, "z01-checkpoint")
    for _ in range(2):
        daily_file_stream(t.spark, landing, MOV_DDL, target, ckpt, keys=["date", "transaction_id"],
                          partition_col="period", partition_expr=F.date_format("date", "yyyy-MM"))
    return target.read().groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


def movement_files(t):
    """The movements as CSV files in folders by year."""
    cols = B.movements(t).select("account_number", "date", "amount", F.year("date").alias("year"))
    return landed(t, "movement-files", lambda p: cols.hint("rebalance", F.col("year")).write.partitionBy("year").option("header", True).csv(p))


def ledger_store(t) -> LedgerStore:
    """Every movement file loaded by the stream, four a commit."""
    def build():
        store = LedgerStore(t.spark, scratch_path(t.spark, "ledger-store"))
        ledger_stream(t.spark, movement_files(t), "account_number string, date date, amount decimal(18,2)", store,
                      scratch_path(t.spark, "ledger-checkpoint"), max_files=4)
        return store
    return t.memo("ledger_store", build)


@query("z01_ledger_by_file", sql("""
SELECT date, account_number, currency, CAST(starting_balance AS DOUBLE) AS starting_balance,
       CAST(total_movements AS DOUBLE) AS total_movements, CAST(closing_balance AS DOUBLE) AS closing_balance
FROM w15""", "w15"))
def z01_ledger(t):
    """The daily balances of W15 from a ledger kept file by file."""
    lo, hi = B.ledger_bounds(t)
    return _dbl(ledger_store(t).balances(B.accounts(t), lo, hi), "starting_balance", "total_movements", "closing_balance") \
        .select("date", "account_number", "currency", "starting_balance", "total_movements", "closing_balance")


@query("x02_resume_from_state", sql("""
SELECT a.account_number, CAST(a.opening_balance + coalesce(m.total, 0) AS DOUBLE) AS starting_balance
FROM accounts a LEFT JOIN (SELECT account_number, sum(amount) AS total FROM movements GROUP BY account_number) m
     ON m.account_number = a.account_number""", "accounts", "movements"))
def x02_state(t):
    """The balance every account resumes from, read from the last month's
    state alone."""
    return ledger_store(t).closing(B.accounts(t)).select("account_number", F.col("opening_balance").cast("double").alias("starting_balance"))


# --- set and order operators -------------------------------------------------------

@query("u01_union_all", sql("""
SELECT type, count(*) AS n FROM (SELECT type FROM movements UNION ALL SELECT 'Internal Sweep' FROM sw_water
                                 UNION ALL SELECT 'Internal Sweep' FROM sw_water) GROUP BY type
""", "movements", "sw_water"))
def u01(t):
    mv, _ = sweeps(t, "waterfall")
    return B.movements(t).unionByName(mv).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("u03_distinct", sql("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT date, currency FROM rate_lines)) AS distinct_pairs,
       (SELECT count(DISTINCT date) FROM rate_lines) AS distinct_dates""", "rate_lines"))
def u03(t):
    r = QF.rate_lines(t)
    pairs = r.select("date", "currency").distinct()
    return pairs.agg(F.count(F.lit(1)).alias("distinct_pairs"), F.count_distinct("date").alias("distinct_dates"))


@query("t01_order_by", sql("SELECT * FROM coll_report ORDER BY report_date, bank_id", "coll_report"))
def t01(t):
    return collateral(t).orderBy("report_date", "bank_id")


@query("t03_head_n", sql("""
SELECT date, currency, fx_to_usd FROM fx_history ORDER BY date, currency LIMIT 10""", "fx_history"))
def t03(t):
    return QF.history(t).select("date", "currency", "fx_to_usd").orderBy("date", "currency").limit(10)


@query("p06_rename_reorder", sql("""
SELECT date, account_number, currency, CAST(starting_balance AS DOUBLE) AS starting_balance,
       CAST(total_movements AS DOUBLE) AS total_movements, CAST(closing_balance AS DOUBLE) AS closing
FROM ledger""", "ledger"))
def p06(t):
    led = ledger(t)
    return led.select("date", "account_number", "currency",
                      F.col("starting_balance").cast("double").alias("starting_balance"),
                      F.col("total_movements").cast("double").alias("total_movements"),
                      F.col("closing_balance").cast("double").alias("closing"))
