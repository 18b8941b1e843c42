"""Position operators: P07 first_row_attributes, W04 cumulative_mtm, D06
trade_valuation, D11 split_across_banks (W13, W14), D13 value_date_rules,
W12 daily_sequence_id."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.functions import text as T
from tesoro.operators import intervals as I
from tesoro.operators import ranged
from tesoro.operators.calendar import roll_to_business_day

# Fixed value that must equal the reference's limit: daily trade numbers have four digits.
MAX_DAILY_SEQUENCE = 9_999


def first_row_attributes(df: DataFrame, key: str, attrs: list[str], order: list[str]) -> DataFrame:
    """Per key, the attributes of the first row by an explicit order
    (the reference relied on row order; ``min_by`` makes it deterministic
    and is a plain hash aggregate with partial aggregation)."""
    order_struct = F.struct(*[F.col(c) for c in order])
    picked = F.min_by(F.struct(*[F.col(a) for a in attrs]), order_struct).alias("_first")
    out = df.groupBy(key).agg(picked)
    return out.select(key, *[F.col(f"_first.{a}").alias(a) for a in attrs])


def cumulative_mtm(df: DataFrame, key: str, date_col: str, step_col: str, size_col: str,
                   cum_type: str = "decimal(16,6)") -> DataFrame:
    """Running sum of daily steps per trade; mtm = round(cum, 6),
    pnl = round(cum × size, 2) (a level, not a daily P&L: Trap8)."""
    w = Window.partitionBy(key).orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum(step_col).over(w).cast(cum_type)
    return (df.withColumn("_cum", cum)
            .withColumn("mtm", F.round(F.col("_cum"), 6))
            .withColumn("pnl", F.round(F.col("_cum") * F.col(size_col), 2))
            .drop("_cum"))


def valuation_dates(legs: DataFrame, business_days: DataFrame, as_of, trade_col: str = "trade_id",
                    bank_col: str = "bank_id", size_col: str = "trade_size_usd",
                    order: tuple[str, ...] = ("trade_date", "bank_id", "leg_id"),
                    date_col: str = "report_date", extra_attrs: tuple[str, ...] = (), keep=None) -> DataFrame:
    """D06 dates: business days in [trade_date, min(max value_date, as_of)],
    inclusive (Trap5, Trap6), with the first leg's bank and size (Trap7).

    ``keep``, if given, gets the rows of one a trade before their days are
    written out and returns them, staged or dealt by trade."""
    attrs = [bank_col, size_col, *extra_attrs]
    first = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.struct(*[F.col(c) for c in order])).alias("_first")
    t = (legs.groupBy(trade_col).agg(F.min("trade_date").alias("trade_date"), F.max("value_date").alias("_last_value"), first)
         .select(trade_col, "trade_date", "_last_value", *[F.col(f"_first.{a}").alias(a) for a in attrs]))
    t = t.withColumn("_end", F.least(F.col("_last_value"), F.lit(as_of).cast("date"))).drop("_last_value")
    t = keep(t) if keep else t
    days = I.expand_active(t, business_days, "trade_date", "_end", date_col, inclusive_end=True)
    return days.drop("_end")


def trade_valuation(dated_steps: DataFrame, trade_col: str = "trade_id",
                    bank_col: str = "bank_id", date_col: str = "report_date",
                    step_col: str = "step", size_col: str = "trade_size_usd") -> DataFrame:
    """(report_date, trade_id, bank_id, mtm, pnl, trade_size_usd)."""
    out = cumulative_mtm(dated_steps, trade_col, date_col, step_col, size_col)
    return out.select(date_col, trade_col, bank_col, "mtm", "pnl", size_col)


def running_allocation(df: DataFrame, group: list[str], capacity_col: str, need_col: str,
                       order: list, out_col: str = "allocated") -> DataFrame:
    """Greedy allocation of ``need`` over rows in ``order``:
    alloc = max(0, min(cap, need − Σ cap of earlier rows))."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(capacity_col).over(w), F.lit(0))
    return df.withColumn(out_col, F.greatest(F.lit(0), F.least(
        F.col(capacity_col), F.col(need_col) - before)))


def share_of_total(df: DataFrame, group: list[str], value_col: str, out_col: str = "share") -> DataFrame:
    """Value / Σ value over the group."""
    tot = F.sum(value_col).over(Window.partitionBy(*group))
    return df.withColumn(out_col, F.when(tot != 0, F.col(value_col) / tot))


def split_across_banks(capacity: DataFrame, trade_col: str = "trade_id", bank_col: str = "bank_id",
                       capacity_col: str = "remaining_usd", need_col: str = "need_usd") -> DataFrame:
    """Allocate each trade's need over banks with positive capacity,
    largest capacity first (bank id breaks ties).  A trade whose total
    capacity + 0.000001 is below its need is rejected (no rows).  Money is
    decimal throughout, so the test is exact; amounts are cents
    (DECIMAL(18,2)) and the rounding residual goes to the last bank that
    received an amount."""
    c = capacity.filter(F.col(capacity_col) > 0)
    c = c.withColumn("_exact", F.col(capacity_col).cast("decimal(24,6)"))
    tot = F.sum("_exact").over(Window.partitionBy(trade_col))
    c = c.withColumn("_total", tot).filter(F.col("_total") + F.lit(Decimal("0.000001")) >= F.col(need_col).cast("decimal(24,6)"))
    c = (c.withColumn("_cap", F.round("_exact", 2).cast("decimal(18,2)"))
         .withColumn("_need", F.col(need_col).cast("decimal(18,2)")))
    order = [F.desc(capacity_col), F.col(bank_col)]
    c = running_allocation(c, [trade_col], "_cap", "_need", order, "allocated_usd")
    c = c.filter(F.col("allocated_usd") > 0)
    w = Window.partitionBy(trade_col)
    resid = F.col("_need") - F.sum("allocated_usd").over(w)
    last = F.row_number().over(Window.partitionBy(trade_col).orderBy(
        F.col(capacity_col).asc(), F.desc(bank_col))) == 1
    c = c.withColumn("allocated_usd", F.when(last & (resid > 0), F.col("allocated_usd") + resid)
                     .otherwise(F.col("allocated_usd")))
    return c.select(trade_col, bank_col, "allocated_usd")


def split_legs_pro_rata(allocations: DataFrame, legs: DataFrame, trade_col: str = "trade_id",
                        leg_col: str = "leg_id", leg_amount_col: str = "leg_amount_usd",
                        total_col: str = "need_usd") -> DataFrame:
    """D11 (legs): each bank's allocation spread over the trade's legs in
    proportion, rounded to cents; the last leg takes the remainder."""
    j = allocations.join(legs, trade_col)
    ratio = F.col("allocated_usd").cast("double") / F.col(total_col).cast("double")
    j = j.withColumn("_amt", F.round(F.col(leg_amount_col).cast("double") * ratio, 2).cast("decimal(18,2)"))
    w = Window.partitionBy(trade_col, "bank_id")
    is_last = F.col(leg_col) == F.max(leg_col).over(w)
    others = F.sum(F.when(~is_last, F.col("_amt")).otherwise(F.lit(0))).over(w)
    return j.withColumn("split_amount_usd", F.when(is_last, F.col("allocated_usd") - others)
                        .otherwise(F.col("_amt"))).drop("_amt")


def raw_value_dates(trades: DataFrame, type_col: str = "type", months_col: str = "tenor_months",
                    date_col: str = "trade_date") -> DataFrame:
    """D13 before the roll: spot = +1 day; forward = +n months; swap = near
    leg +2 days and far leg +n months.  One row per leg (leg_id 1, 2)."""
    d, n, ty = F.col(date_col), F.col(months_col), F.col(type_col)
    leg = lambda i, v: F.struct(F.lit(i).alias("leg_id"), v.alias("raw_value_date"))
    legs = (F.when(ty == "spot", F.array(leg(1, F.date_add(d, 1))))
            .when(ty == "forward", F.array(leg(1, F.add_months(d, n))))
            .when(ty == "swap", F.array(leg(1, F.date_add(d, 2)), leg(2, F.add_months(d, n)))))
    return trades.select("*", F.inline(legs))


def value_date_rules(trades: DataFrame, calendar: DataFrame, type_col: str = "type",
                     months_col: str = "tenor_months", date_col: str = "trade_date") -> DataFrame:
    """The raw value dates rolled to a business day."""
    return roll_to_business_day(raw_value_dates(trades, type_col, months_col, date_col), "raw_value_date",
                                calendar, "value_date")


def daily_sequence_id(df: DataFrame, date_col: str, prefix_col, order: list,
                      width: int = 4, out_col: str = "trade_id", step: int | None = None, rows: int | None = None) -> DataFrame:
    """``prefix + yyyymmdd + zero-padded sequence`` numbered per day in
    plain key order.  A day with more rows than ``width`` digits can number
    fails the job (Q04): a cut number would repeat an id.  ``rows`` or ``step``
    number wide days in parallel without changing any number, see
    :func:`dense_sequence`.  Adds ``seq``.
    """
    prefix = prefix_col if not isinstance(prefix_col, str) else F.col(prefix_col)
    out = dense_sequence(df, [date_col], order, step, "seq", rows)
    return out.withColumn(out_col, T.daily_id(prefix, F.col(date_col), F.col("seq"), width))


def dense_sequence(df: DataFrame, group: list[str], order: list, step: int | None = None,
                   out_col: str = "seq", rows: int | None = None) -> DataFrame:
    """1, 2, 3 … within each group, in ``order``.

    With ``rows``, groups of more rows are numbered by ranges of the first
    order column (a number), cut at its quantiles (:mod:`.ranged`).

    Without either this is a ``row_number`` window — one sort per group.
    With ``step``, each group is cut into slices of ``step`` consecutive values of
    the first order column (a number): rows are numbered within (group,
    slice) in parallel and shifted by the row counts of the group's earlier
    slices.  Slices are ranges of the ordering key, so the numbers are the
    same for every ``step``.
    """
    if rows is not None:
        first = F.col(order[0]) if isinstance(order[0], str) else order[0]
        return ranged.running(df, group, first, order, number=out_col, rows=rows).withColumn(out_col, F.col(out_col).cast("int"))
    if step is None:
        return df.withColumn(out_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("int"))
    lead = F.col(order[0]) if isinstance(order[0], str) else order[0]
    b = df.withColumn("_slice", F.floor(lead / F.lit(step)))
    rn = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
    counts = b.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("_n")
    # left join on a key-unique side: row count is unchanged, and Catalyst
    # drops the join entirely when the caller never reads the number
    return (b.withColumn("_rn", rn).join(offsets, [*group, "_slice"], "left")
            .withColumn(out_col, (F.col("_off") + F.col("_rn")).cast("int"))
            .drop("_slice", "_rn", "_off"))


def steps_from_rate(rate_col: str, date_col: str) -> F.Column:
    """Binding helper: a deterministic daily MTM step from a per-trade rate
    (re-aimed random walk): rate × ((day mod 5) − 2) × 0.01."""
    k = ((F.dayofmonth(F.col(date_col)) % 5) - 2).cast("decimal(2,0)")
    return (F.col(rate_col) * k * F.lit(Decimal("0.01"))).cast("decimal(12,6)")
