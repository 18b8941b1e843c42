"""D08 sweep_allocation (J16 + W13): move cash from surplus to deficit
accounts of the same pool (date, currency).

Deficits are served most negative first, surpluses are drawn largest first
(account number breaks ties: the reference's sort is unstable, T05).

* ``snapshot`` (the reference's literal behaviour, Trap11): every deficit
  walks the *frozen* surplus list independently, so with two deficits the
  same surplus can be spent twice.  Deficit i takes
  ``t_ij = max(0, min(S_j, need_i − ΣS_{k<j}))``.
* ``waterfall`` (default): each unit of surplus is spent once.  Deficits and
  surpluses get cumulative intervals on one axis; a transfer is the overlap
  of a deficit's and a surplus's interval.

Neither form joins every deficit with every surplus.  Snapshot counts, per
deficit, how many surpluses it reaches (a sorted merge done with one
window), then fetches exactly those by an equi join on the surplus rank.
Waterfall merges the cut points of both lists with windows.  The output is
only the transfers that actually happen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.functions import text as T
from tesoro.operators import ranged
from tesoro.session import staged

# Fixed values that must equal the reference's output.
SWEEP_TYPE = "Internal Sweep"
SWEEP_CATEGORY = "Treasury"
MOVEMENT_COLUMNS = ["date", "transaction_id", "account_number", "currency", "type", "category",
                    "amount", "description"]
AMOUNT = "decimal(18,2)"
SUM = "decimal(28,2)"


def _sides(balances: DataFrame, pool: list[str], account: str, balance: str, rows: int):
    b = balances.select(*pool, account, F.col(balance).cast(AMOUNT).alias("_bal"))
    d = b.filter(F.col("_bal") < 0).select(*pool, F.col(account).alias("deficit_acct"),
                                           (-F.col("_bal")).alias("need"))
    s = b.filter(F.col("_bal") > 0).select(*pool, F.col(account).alias("surplus_acct"),
                                           F.col("_bal").alias("avail"))
    d = ranged.running(d, pool, -F.col("need"), [F.desc("need"), "deficit_acct"], {"d_lo": "need"}, rows=rows)
    s = ranged.running(s, pool, -F.col("avail"), [F.desc("avail"), "surplus_acct"], {"s_lo": "avail"}, "s_rank", rows=rows)
    d = d.withColumn("d_lo", F.col("d_lo").cast(SUM)).withColumn("d_hi", (F.col("d_lo") + F.col("need")).cast(SUM))
    s = s.withColumn("s_lo", F.col("s_lo").cast(SUM)).withColumn("s_hi", (F.col("s_lo") + F.col("avail")).cast(SUM))
    # by ranges, each side is read several times
    return staged(d, "sweep-deficits"), staged(s, "sweep-surpluses")


def _whole_pools(balances: DataFrame, pool: list[str], account: str, balance: str, mode: str) -> DataFrame:
    """The transfers where a pool's accounts fit one task: the balances are
    dealt by pool once, and every rank, sum and cut point is a window there."""
    bal = F.col("_bal")
    b = balances.select(*pool, F.col(account).alias("_acct"), F.col(balance).cast(AMOUNT).alias("_bal")).filter(bal != 0)
    b = b.withColumn("_kind", F.when(bal > 0, 1).otherwise(0)).withColumn("_amt", F.abs(bal).cast(AMOUNT)).drop("_bal").repartition(*pool)
    side = Window.partitionBy(*pool, "_kind").orderBy(F.desc("_amt"), "_acct")
    lo = F.coalesce(F.sum("_amt").over(side.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(SUM)
    if mode == "waterfall":
        cuts = b.select(*pool, "_kind", "_acct", "_amt", lo.alias("_pos")).withColumn("_end", (F.col("_pos") + F.col("_amt")).cast(SUM)).drop("_amt")
        return _overlaps(_segments(cuts, pool, None), pool)
    # k_i = #surpluses whose start lies strictly below need_i; a deficit is no
    # surplus itself, so those before it are those up to it
    both = b.select("*", lo.alias("s_lo"), F.row_number().over(side).alias("s_rank"))
    deficit = F.col("_kind") == 0
    both = both.withColumn("_v", F.when(deficit, F.col("_amt")).otherwise(F.col("s_lo").cast(AMOUNT)))
    marks = Window.partitionBy(*pool).orderBy("_v", "_kind", F.when(deficit, F.col("_acct")))
    both = both.withColumn("_k", F.when(deficit, F.coalesce(F.sum("_kind").over(marks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    # only surpluses that some deficit of the pool reaches are fetched
    s = (both.withColumn("_reach", F.max("_k").over(Window.partitionBy(*pool))).filter((F.col("_kind") == 1) & (F.col("s_rank") <= F.col("_reach")))
         .select(*pool, "s_rank", F.col("_acct").alias("surplus_acct"), F.col("_amt").alias("avail"), "s_lo"))
    # an account that stands more than once among the deficits reaches as far as each of its rows
    d = both.filter(deficit & F.col("_acct").isNotNull())
    d = d.withColumn("_ks", F.collect_list("_k").over(Window.partitionBy(*pool, "_acct")))
    dk = d.select(*pool, F.col("_acct").alias("deficit_acct"), F.col("_amt").alias("need"), F.explode("_ks").alias("_k")).filter(F.col("_k") > 0)
    dk = dk.withColumn("s_rank", F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))))
    pairs = dk.join(s, [*pool, "s_rank"])
    amt = F.least(F.col("avail"), (F.col("need") - F.col("s_lo")).cast(AMOUNT))
    return pairs.select(*pool, "deficit_acct", "surplus_acct", amt.cast(AMOUNT).alias("amount"))


def sweep_transfers(balances: DataFrame, pool: list[str] | None = None,
                    account: str = "account_number", balance: str = "closing_balance",
                    mode: str = "waterfall", range_rows: int = ranged.RANGE_ROWS) -> DataFrame:
    """(pool…, deficit_acct, surplus_acct, amount) — one row per transfer.

    If a pool has more than ``range_rows`` accounts (counted first), its sums,
    ranks and cut points are taken by ranges, many tasks a pool."""
    pool = pool or ["date", "currency"]
    rows = range_rows if ranged.has_wide_groups(balances, pool, range_rows) else None
    if mode not in ("waterfall", "snapshot"):
        raise ValueError(f"unknown sweep mode {mode!r}")
    if rows is None:
        return _whole_pools(balances, pool, account, balance, mode)
    d, s = _sides(balances, pool, account, balance, rows)
    if mode == "snapshot":
        # k_i = #surpluses whose start lies strictly below need_i
        marks = (d.select(*pool, F.col("need").alias("_v"), F.lit(1).alias("_kind"), "deficit_acct")
                 .unionByName(s.select(*pool, F.col("s_lo").cast(AMOUNT).alias("_v"), F.lit(0).alias("_kind"),
                                       F.lit(None).cast(d.schema["deficit_acct"].dataType).alias("deficit_acct"))))
        # a deficit is no surplus itself, so those before it are those up to it
        k = ranged.running(marks.withColumn("_one", 1 - F.col("_kind")), pool, F.col("_v"), ["_v", F.desc("_kind"), "deficit_acct"],
                           {"_k": "_one"}, rows=rows)
        k = k.filter(F.col("_kind") == 1).select(*pool, "deficit_acct", "_k")
        dk = d.join(k, [*pool, "deficit_acct"]).filter(F.col("_k") > 0)
        dk = dk.withColumn("s_rank", F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))))
        pairs = dk.join(s, [*pool, "s_rank"])
        amt = F.least(F.col("avail"), (F.col("need") - F.col("s_lo")).cast(AMOUNT))
        return pairs.select(*pool, "deficit_acct", "surplus_acct", amt.cast(AMOUNT).alias("amount"))
    cuts = (d.select(*pool, F.col("d_lo").alias("_pos"), F.lit(0).alias("_kind"),
                     F.col("deficit_acct").alias("_acct"), F.col("d_hi").alias("_end"))
            .unionByName(s.select(*pool, F.col("s_lo").alias("_pos"), F.lit(1).alias("_kind"),
                                  F.col("surplus_acct").alias("_acct"), F.col("s_hi").alias("_end"))))
    return _overlaps(_segments(cuts, pool, rows), pool)


def _overlaps(seg: DataFrame, pool: list[str]) -> DataFrame:
    """The transfers: the length that a deficit and a surplus share."""
    seg = seg.withColumn("_len", (F.least(F.col("_next"), F.col("_limit")) - F.col("_pos")).cast(SUM))
    seg = seg.filter((F.col("_len") > 0) & F.col("deficit_acct").isNotNull() & F.col("surplus_acct").isNotNull())
    return (seg.groupBy(*pool, "deficit_acct", "surplus_acct")
            .agg(F.sum("_len").cast(AMOUNT).alias("amount")))


def _segments(cuts: DataFrame, pool: list[str], rows: int | None) -> DataFrame:
    """The cut points with the deficit and the surplus that hold there, the
    next cut point and the end of the shorter side."""
    def own(kind, column):
        return F.when(F.col("_kind") == kind, F.col(column))

    keys = pool
    if rows is not None:
        cuts, keys = ranged.with_slices(cuts, pool, F.col("_pos"), rows), [*pool, ranged.SLICE]
    order = Window.partitionBy(*keys).orderBy("_pos", "_kind", "_acct")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*pool)
    seg = (cuts.withColumn("deficit_acct", F.last(own(0, "_acct"), ignorenulls=True).over(upto))
           .withColumn("surplus_acct", F.last(own(1, "_acct"), ignorenulls=True).over(upto)))
    if rows is None:
        limit = F.least(F.max(own(0, "_end")).over(whole), F.max(own(1, "_end")).over(whole))
        return seg.withColumn("_limit", limit).withColumn("_next", F.coalesce(F.lead("_pos").over(order), F.col("_limit")))
    place = F.struct("_pos", "_kind", "_acct")
    totals = cuts.groupBy(*keys).agg(
        F.min("_pos").alias("_first"), F.max_by("_acct", F.when(F.col("_kind") == 0, place)).alias("_d"),
        F.max_by("_acct", F.when(F.col("_kind") == 1, place)).alias("_s"), F.max(own(0, "_end")).alias("_d_end"), F.max(own(1, "_end")).alias("_s_end"))
    slices = Window.partitionBy(*pool).orderBy(ranged.SLICE)
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, F.lead("_first").over(slices).alias("_first_after"), F.last("_d", ignorenulls=True).over(before).alias("_d_before"),
                           F.last("_s", ignorenulls=True).over(before).alias("_s_before"),
                           F.least(F.max("_d_end").over(whole), F.max("_s_end").over(whole)).alias("_limit"))
    seg = ranged.shifted(seg.withColumn("_next", F.lead("_pos").over(order)), pool, totals)
    return (seg.withColumn("deficit_acct", F.coalesce("deficit_acct", "_d_before")).withColumn("surplus_acct", F.coalesce("surplus_acct", "_s_before"))
            .withColumn("_next", F.coalesce("_next", "_first_after", "_limit")))


def sweep_movements(transfers: DataFrame, date_col: str = "date", currency_col: str = "currency") -> DataFrame:
    """Two movement legs per transfer: +t on the deficit, −t on the surplus."""
    def leg(own, other, amount, text):
        return F.struct(F.col(date_col).alias("date"), T.sweep_id(own, other).alias("transaction_id"),
                        F.col(own).cast("string").alias("account_number"), F.col(currency_col).alias("currency"),
                        F.lit(SWEEP_TYPE).alias("type"), F.lit(SWEEP_CATEGORY).alias("category"),
                        amount.cast(AMOUNT).alias("amount"),
                        F.concat(F.lit(text), F.col(other).cast("string")).alias("description"))

    # both legs from one pass, so the transfers are computed once
    return transfers.select(F.inline(F.array(
        leg("deficit_acct", "surplus_acct", F.col("amount"), "Sweep from "),
        leg("surplus_acct", "deficit_acct", -F.col("amount"), "Sweep to "))))


def apply_sweeps(balances: DataFrame, movements: DataFrame, pool: list[str] | None = None,
                 account: str = "account_number", balance: str = "closing_balance") -> DataFrame:
    """New closing = closing + Σ sweep legs of the account that day."""
    pool = pool or ["date", "currency"]
    delta = movements.groupBy(*pool, "account_number").agg(F.sum("amount").alias("sweep_amount"))
    delta = delta.withColumnRenamed("account_number", account)
    j = balances.join(delta, [*pool, account], "left")
    sweep = F.coalesce(F.col("sweep_amount"), F.lit(0).cast(AMOUNT))
    return (j.withColumn("sweep_amount", sweep.cast(AMOUNT))
            .withColumn(balance, (F.col(balance).cast(AMOUNT) + F.col("sweep_amount")).cast(AMOUNT)))


def sweep_allocation(balances: DataFrame, mode: str = "waterfall", pool: list[str] | None = None,
                     account: str = "account_number", balance: str = "closing_balance"):
    """Returns (sweep movements, balances with the swept closing)."""
    pool = pool or ["date", "currency"]
    tr = sweep_transfers(balances, pool, account, balance, mode)
    mv = sweep_movements(tr, pool[0], pool[1] if len(pool) > 1 else pool[0])
    return mv, apply_sweeps(balances, mv, pool, account, balance)
