"""Treasury ledger: W15 balance_roll_forward, D09 ledger_roll_forward (with
daily sweeps), D12 month_end_interest, D16 sweep_decomposition, W09/W10
period-to-date sums.

D09 is the one path-dependent recurrence that crosses accounts: a sweep on
day t changes the opening balances of day t+1.  Nothing is swept before a pool
(currency) has its first overdrawn account, though, and that day is found from
sums of each account's own movements.  Up to it balances are prefix sums,
parallel over accounts; a pool without a deficit never goes further.  From
that day on the pool is the unit of parallelism: its rows are hash-partitioned
together and sorted by day, and a ``mapInPandas`` kernel streams them, holding
only one balance per account in memory (never the pool's history), from the
balances carried over.  Movements are first pre-aggregated to one row per
(account, day).  All money is integer cents, so results are exact.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.operators.sweep import AMOUNT, SWEEP_TYPE
from tesoro.session import staged

EPOCH = dt.date(1970, 1, 1)
BALANCE_COLUMNS = ["date", "account_number", "currency", "starting_balance", "total_movements",
                   "closing_balance"]

# Fixed values that must equal the reference's output.
INTEREST_TYPE, INTEREST_CATEGORY, INTEREST_TEXT = "Interest", "Income", "Month-end interest"
DEFAULT_OPENING = "100000.00"   # starting balance when an account has no history


def balance_roll_forward(opening: DataFrame, movements: DataFrame, start, end, account: str = "account_number",
                         pool: str = "currency", date_col: str = "date", amount: str = "amount",
                         opening_col: str = "opening_balance") -> DataFrame:
    """W15 (no sweeps): every account on every day of [start, end]; starting =
    previous closing (or the opening balance; ``DEFAULT_OPENING`` where that
    is NULL), closing = starting + Σ movements of the day (0 when none).

    Movements of accounts that are not in ``opening`` are left out, as the
    reference's left join from the accounts does."""
    return daily_balances(balance_steps(opening, movements, start, end, account, pool, date_col, amount, opening_col), account, pool, date_col)


def balance_steps(opening: DataFrame, movements: DataFrame, start, end, account: str = "account_number",
                  pool: str = "currency", date_col: str = "date", amount: str = "amount",
                  opening_col: str = "opening_balance") -> DataFrame:
    """W15 before the days without movements are written out: one row an
    account and day with a movement, and one for its days before the first,
    good for the days ``_from`` to ``_to``.  Only these rows are shuffled and
    sorted; the accounts x days of the output never are.

    An account that stands in ``opening`` more than once has a row of each of
    its openings a day, and a day's movement counts with each of them."""
    daily = (movements.filter(F.col(date_col).between(F.lit(start), F.lit(end)) & F.col(account).isNotNull()).groupBy(account, date_col)
             .agg(F.sum(F.col(amount).cast(AMOUNT)).cast("decimal(28,2)").alias("_moved")))
    owners = opening.groupBy(account).agg(F.sort_array(F.collect_list(F.struct(opening_amount(opening_col).alias("_open"), F.col(pool)))).alias("_own"))
    rows = daily.withColumn("_own", F.lit(None).cast(owners.schema["_own"].dataType)).unionByName(
        owners.withColumn(date_col, F.date_sub(F.lit(start).cast("date"), 1)).withColumn("_moved", F.lit(0).cast("decimal(28,2)")))
    order = Window.partitionBy(account).orderBy(date_col)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(account, date_col, F.coalesce("_moved", F.lit(0)).cast("decimal(28,2)").alias("_moved"), F.first("_own").over(upto).alias("_own"),
                       F.sum("_moved").over(upto).alias("_sum"), F.lead(date_col).over(order).alias("_next"))
    rows = rows.select(account, F.greatest(F.col(date_col), F.lit(start).cast("date")).alias("_from"),
                       F.coalesce(F.date_sub("_next", 1), F.lit(end).cast("date")).alias("_to"), "_moved", "_sum",
                       F.size("_own").alias("_n"), F.posexplode("_own").alias("_at", "_o")).filter(F.col("_from") <= F.col("_to"))
    before = F.col("_o._open") + (F.col("_sum") - F.col("_moved")) * F.col("_n")
    return rows.select(account, F.col(f"_o.{pool}").alias(pool), "_from", "_to", "_moved",
                       (before + F.col("_moved") * (F.col("_at") + 1)).cast("decimal(28,2)").alias("_closing"),
                       (before + F.col("_moved") * F.col("_n")).cast("decimal(28,2)").alias("_after"))


def daily_balances(steps: DataFrame, account: str = "account_number", pool: str = "currency", date_col: str = "date") -> DataFrame:
    """The days of :func:`balance_steps`, written out without a shuffle."""
    days = steps.select(account, pool, "_moved", "_closing", "_after", "_from", F.explode(F.sequence("_from", "_to")).alias(date_col))
    first, nothing = F.col(date_col) == F.col("_from"), F.lit(0).cast("decimal(28,2)")
    total, closing = F.when(first, F.col("_moved")).otherwise(nothing), F.when(first, F.col("_closing")).otherwise(F.col("_after"))
    return days.select(date_col, account, pool, (closing - total).cast("decimal(28,2)").alias("starting_balance"),
                       total.alias("total_movements"), closing.alias("closing_balance"))


def opening_amount(col: str = "opening_balance"):
    """The opening balance, ``DEFAULT_OPENING`` where it is not known."""
    return F.coalesce(F.col(col).cast(AMOUNT), F.lit(DEFAULT_OPENING).cast(AMOUNT))


def _sweep_cents(pre: np.ndarray, mode: str) -> np.ndarray:
    """Net sweep per account (cents) for one pool-day; ``pre`` is the
    pre-sweep balance in account order (the index is the tie-break)."""
    out = np.zeros_like(pre)
    idx = np.arange(len(pre))
    d = idx[pre < 0]
    s = idx[pre > 0]
    if len(d) == 0 or len(s) == 0:
        return out
    d = d[np.lexsort((d, pre[d]))]            # most negative first
    s = s[np.lexsort((s, -pre[s]))]           # largest surplus first
    need, avail = -pre[d], pre[s]
    tot_need, tot_avail = need.sum(), avail.sum()
    before_s = np.cumsum(avail) - avail
    if mode == "waterfall":
        before_d = np.cumsum(need) - need
        out[d] = np.clip(tot_avail - before_d, 0, need)
        out[s] = -np.clip(tot_need - before_s, 0, avail)
    elif mode == "snapshot":
        out[d] = np.minimum(need, tot_avail)
        srt = np.sort(need)
        suffix = np.concatenate([np.cumsum(srt[::-1])[::-1], [0]])

        def above(x):  # Σ max(need − x, 0)
            k = np.searchsorted(srt, x, side="right")
            return suffix[k] - x * (len(srt) - k)
        out[s] = -(above(before_s) - above(before_s + avail))
    else:
        raise ValueError(f"unknown sweep mode {mode!r}")
    return out


FLUSH_ROWS = 100_000


class _PoolStream:
    """Day-by-day state of one pool inside the D09 kernel: one balance per
    account.  Output frames have at most about ``FLUSH_ROWS`` rows (or one
    day of the pool, whichever is more), however quiet the pool is."""

    def __init__(self, key, accounts: np.ndarray, cents: np.ndarray, first_day: int, mode: str, pool_cols: list[str]):
        order = np.argsort(accounts, kind="stable")
        self.key, self.mode, self.day, self.pool_cols = key, mode, first_day, pool_cols
        self.accts, self.bal = accounts[order], cents[order]
        self.out: list[tuple] = []

    def advance(self, upto: int, accounts: np.ndarray | None = None, cents: np.ndarray | None = None):
        """Roll to the end of day ``upto``; the movements given are of that
        day.  Yields the frames that are full."""
        while self.day <= upto:
            mov = np.zeros(len(self.accts), dtype=np.int64)
            if accounts is not None and self.day == upto and len(self.accts):
                at = np.minimum(np.searchsorted(self.accts, accounts), len(self.accts) - 1)
                known = self.accts[at] == accounts      # movements without an account are left out
                np.add.at(mov, at[known], cents[known])
            pre = self.bal + mov
            sw = _sweep_cents(pre, self.mode)
            self.out.append((self.day, self.bal, mov, sw, pre + sw))
            self.bal = pre + sw
            self.day += 1
            if len(self.out) * len(self.accts) >= FLUSH_ROWS:
                yield from self.flush()

    def flush(self):
        if not self.out or not len(self.accts):
            self.out = []
            return
        days, start, mov, sweep, close = zip(*self.out)
        df = pd.DataFrame({"day": np.repeat(np.array(days, dtype=np.int32), len(self.accts)),
                           "account_number": np.tile(self.accts, len(days)), "start_c": np.concatenate(start),
                           "mov_c": np.concatenate(mov), "sweep_c": np.concatenate(sweep), "close_c": np.concatenate(close)})
        for c, v in zip(self.pool_cols, self.key):
            df[c] = v
        self.out = []
        yield df


def _ledger_kernel(first_day: int, last_day: int, mode: str, pool_cols: list[str]):
    """mapInPandas body: rows arrive grouped by pool and sorted by
    (day, kind); kind 0 = opening balance (on the day before the pool's
    first), kind 1 = a day's net movement.  Rows are taken a day of a pool at a time; a day
    that ends a batch waits for the next one."""
    def run(batches):
        key, stream, kept = None, None, None

        def finish():
            if stream is not None:
                yield from stream.advance(last_day)
                yield from stream.flush()

        def day_of(part):
            nonlocal key, stream
            own = tuple(part[c].iat[0] for c in pool_cols)
            day = int(part["day"].iat[0])
            accounts, cents = part["account_number"].to_numpy(dtype=object), part["cents"].to_numpy(dtype=np.int64)
            if own != key:
                yield from finish()
                key = own
                opening = part["kind"].iat[0] == 0
                stream = _PoolStream(key, accounts if opening else accounts[:0], cents if opening else cents[:0],
                                     day + 1 if opening else first_day, mode, pool_cols)
                if opening:
                    return
            yield from stream.advance(day, accounts, cents)

        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            ids = pdf[[*pool_cols, "day"]]
            last = ids.shift()
            new = ((ids != last) & ~(ids.isna() & last.isna())).any(axis=1).to_numpy()     # NULL is a pool too
            new[0] = True
            cuts = [*np.nonzero(new)[0], len(pdf)]
            for i, j in zip(cuts[:-2], cuts[1:-1]):
                yield from day_of(pdf.iloc[i:j])
            kept = pdf.iloc[cuts[-2]:]
        if kept is not None:
            yield from day_of(kept)
        yield from finish()
    return run


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, NULL equal to NULL, with the keys of ``left``."""
    own = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    return left.join(own, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], how).drop(*[f"_k{i}" for i in range(len(keys))])


def account_days(op: DataFrame, mv: DataFrame, pool: list[str], first_day: int, last_day: int) -> DataFrame:
    """One row an account and day with a movement, after one row for its
    opening (on the day before the first): the day's cents, the balance
    ``after`` it without sweeps, and the ``next`` such day.  Movements without
    an opening are left out.  One shuffle and sort serve all of it."""
    ev = op.select(*pool, "account_number", F.lit(first_day - 1).alias("day"), F.lit(0).alias("kind"), F.col("open").alias("cents")).unionByName(
        mv.select(*pool, "account_number", "day", F.lit(1).alias("kind"), F.coalesce("cents", F.lit(0).cast("long")).alias("cents")))
    order = Window.partitionBy(*pool, "account_number").orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    ev = ev.select("*", F.first("kind").over(upto).alias("_first"), F.sum("cents").over(upto).alias("after"),
                   F.coalesce(F.lead("day").over(order), F.lit(last_day + 1)).alias("next"))
    return ev.filter("_first = 0").drop("_first")


def first_deficits(days: DataFrame, pool: list[str], first_day: int) -> DataFrame:
    """pool…, first: the first day on which an account of the pool is
    overdrawn by its own movements (one that opens overdrawn counts from the
    first day on); one row a pool that has such a day."""
    low = days.filter("after < 0").groupBy(*pool).agg(F.greatest(F.min("day"), F.lit(first_day)).alias("first"))
    return staged(low, "ledger-dips")


def _unswept(days: DataFrame, dips: DataFrame, pool: list[str], first_day: int, last_day: int) -> DataFrame:
    """Days before the pool's first deficit: each row's balance up to the
    account's next movement, written out without a shuffle."""
    until = F.least(F.col("next"), F.coalesce(F.col("first"), F.lit(last_day + 1))) - 1
    j = _match(days, dips, pool, "left").withColumn("_from", F.greatest(F.col("day"), F.lit(first_day))).withColumn("_until", until)
    j = j.filter(F.col("_from") <= F.col("_until"))
    j = j.select(*pool, "account_number", "kind", "cents", "after", "_from", F.explode(F.sequence("_from", "_until")).alias("day"))
    moved = F.when((F.col("kind") == 1) & (F.col("day") == F.col("_from")), F.col("cents")).otherwise(F.lit(0).cast("long"))
    return j.select("day", "account_number", (F.col("after") - moved).alias("start_c"), moved.alias("mov_c"),
                    F.lit(0).cast("long").alias("sweep_c"), F.col("after").alias("close_c"), *pool)


def _swept(op: DataFrame, mv: DataFrame, dips: DataFrame, pool: list[str], first_day: int, last_day: int, mode: str,
           num_partitions: int | None) -> DataFrame:
    """Days from the pool's first deficit on: the kernel, a pool at a time,
    from the balances the accounts have by then (those of their last row
    before that day).  ``op`` and ``mv`` are the :func:`account_days` of the
    openings and of the movements."""
    days = op.unionByName(mv)
    early = F.col("day") < F.col("first")
    ev = _match(days, dips, pool).filter(~early | (F.col("next") >= F.col("first"))).select(
        *pool, "account_number", F.when(early, F.col("first") - 1).otherwise(F.col("day")).cast("int").alias("day"),
        F.when(early, 0).otherwise(1).alias("kind"), F.when(early, F.col("after")).otherwise(F.col("cents")).alias("cents"))
    n = num_partitions or int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ev = ev.repartition(n, *pool).sortWithinPartitions(*pool, "day", "kind", "account_number")
    pool_fields = ", ".join(f"{c} {ev.schema[c].dataType.simpleString()}" for c in pool)
    schema = (f"day int, account_number string, start_c long, mov_c long, sweep_c long, "
              f"close_c long, {pool_fields}")
    return ev.mapInPandas(_ledger_kernel(first_day, last_day, mode, pool), schema)


def ledger_roll_forward(opening: DataFrame, movements: DataFrame, start, end,
                        mode: str = "waterfall", pool: list[str] | None = None,
                        account: str = "account_number", date_col: str = "date",
                        amount: str = "amount", opening_col: str = "opening_balance",
                        num_partitions: int | None = None) -> DataFrame:
    """Daily balances of every account for every day in [start, end]
    with sweeps inside each pool after the day's movements.  An opening
    balance that is NULL is ``DEFAULT_OPENING``; movements of accounts
    without an opening row are left out (the reference's left join from the
    accounts); :func:`unknown_movements` lists them.

    Output: date, account_number, pool…, starting_balance,
    total_movements (excludes sweeps, Trap12), sweep_amount,
    closing_balance — all DECIMAL(18,2)-exact.
    """
    pool = pool or ["currency"]
    start = start if isinstance(start, dt.date) else dt.date.fromisoformat(str(start))
    end = end if isinstance(end, dt.date) else dt.date.fromisoformat(str(end))
    first_day, last_day = (start - EPOCH).days, (end - EPOCH).days
    cents = lambda c: (F.col(c).cast(AMOUNT) * 100).cast("long")
    mv = (movements.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) <= F.lit(end)))
          .groupBy(*pool, account, date_col).agg(F.sum(cents(amount)).alias("cents"))
          .select(*pool, F.col(account).cast("string").alias("account_number"),
                  F.datediff(F.col(date_col), F.lit(EPOCH)).alias("day"), "cents"))
    op = opening.select(*pool, F.col(account).cast("string").alias("account_number"), (opening_amount(opening_col) * 100).cast("long").alias("open"))
    op = op.groupBy(*pool, "account_number").agg(F.sum("open").alias("open"))
    # one row a (account, day), read by both halves
    days = staged(account_days(op, mv, pool, first_day, last_day), "ledger-days")
    dips = first_deficits(days, pool, first_day)
    raw = _unswept(days, dips, pool, first_day, last_day).unionByName(
        _swept(days.filter("kind = 0"), days.filter("kind = 1"), dips, pool, first_day, last_day, mode, num_partitions))
    money = lambda c: (F.col(c).cast("decimal(20,0)") / 100).cast(AMOUNT)
    return raw.select(F.date_add(F.lit(EPOCH), F.col("day")).alias("date"), "account_number", *pool,
                      money("start_c").alias("starting_balance"), money("mov_c").alias("total_movements"),
                      money("sweep_c").alias("sweep_amount"), money("close_c").alias("closing_balance"))


def unknown_movements(opening: DataFrame, movements: DataFrame, account: str = "account_number") -> DataFrame:
    """Movements whose account has no opening row: the rejects of D09/W15."""
    return movements.join(opening.select(account).distinct(), account, "left_anti")


def month_end_interest(balances: DataFrame, calendar: DataFrame, rate: float,
                       date_col: str = "date", start_col: str = "starting_balance") -> DataFrame:
    """On month-end days, interest = round(starting balance × rate, 2)."""
    me = calendar.filter(F.col("is_month_end")).select(F.col("calendar_date").alias(date_col))
    b = balances.join(me, date_col, "left_semi")
    amt = F.round(F.col(start_col).cast(AMOUNT) * F.lit(rate).cast("decimal(10,6)"), 2).cast(AMOUNT)
    return b.select(date_col, "account_number", "currency",
                    F.lit(INTEREST_TYPE).alias("type"), F.lit(INTEREST_CATEGORY).alias("category"),
                    amt.alias("amount"), F.lit(INTEREST_TEXT).alias("description"))


def sweep_decomposition(movements: DataFrame, keys: list[str], type_col: str = "type",
                        amount: str = "amount") -> DataFrame:
    """Movements excluding sweeps, sweeps only.  ``<>`` keeps NULL
    types, as the measure language does (F07)."""
    is_sweep = F.col(type_col).eqNullSafe(F.lit(SWEEP_TYPE))
    a = F.col(amount).cast(AMOUNT)
    return movements.groupBy(*keys).agg(
        F.sum(F.when(~is_sweep, a).otherwise(F.lit(0).cast(AMOUNT))).cast("decimal(28,2)").alias("movements_ex_sweeps"),
        F.sum(F.when(is_sweep, a).otherwise(F.lit(0).cast(AMOUNT))).cast("decimal(28,2)").alias("sweeps_only"))


def period_to_date(df: DataFrame, keys: list[str], date_col: str, value_col: str, period: str,
                   out_col: str) -> DataFrame:
    """W09 (period='month') / W10 (period='year'): running sum within the
    period, per key."""
    per = F.trunc(F.col(date_col), "MM" if period == "month" else "YYYY")
    w = (Window.partitionBy(*keys, per).orderBy(date_col)
         .rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out_col, F.sum(value_col).over(w))
