"""D07 collateral_report: the path-dependent posted-collateral recurrence,
W16 next_day_value, D14 collateral_snapshot.

The recurrence is sequential in days but independent per key (portfolio,
bank, desk).  Inputs are first aggregated to one row per (key, business
day), so each key's series is bounded by the calendar, not by trade volume.
The per-key series is folded with the SQL higher-order ``aggregate``
function — still a Catalyst expression, evaluated in parallel over keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output (collateral policy).
BUFFER = 500_000
MOVE_INCREMENT = 10_000
MIN_MOVE = 50_000
IM_RATE = "0.05"
INITIAL_POSTED = 0  # the reference's initial-collateral constant is unused (Trap9)

STATE = "decimal(20,4)"
BLOCK_DAYS = 256      # days folded together; changes no amount

KPI_COLUMNS = ["initial_margin", "variation_margin", "collateral_required", "collateral_posted", "excess_deficit",
               "total_portfolio", "open_positions"]

REPORT_COLUMNS = ["report_date", "initial_margin", "variation_margin", "collateral_required",
                  "collateral_posted", "excess_deficit"]


def next_day_value(df: DataFrame, keys: list[str], date_col: str, value_col: str,
                   out_col: str | None = None) -> DataFrame:
    """The next date's value; the last date uses its own."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    return df.withColumn(out_col or f"{value_col}_next",
                         F.coalesce(F.lead(value_col).over(w), F.col(value_col)))


def initial_margin(exposure):
    """The report's initial margin: minus 5 % of the exposure, in cents."""
    x = F.coalesce(F.col(exposure), F.lit(0)).cast("decimal(20,2)")
    return F.round(-(x * F.lit(IM_RATE).cast("decimal(3,2)")).cast(STATE), 2)


def _step_sql(buffer: int, inc: int, min_move: int, p: str = "acc.p") -> str:
    """posted(t+1) from posted(t) = ``p`` and today's row x (need, need_next)."""
    excess = f"({p} - x.need)"
    recall = f"least({excess} - {buffer}, {p} - x.need_next - {buffer})"
    post = (f"CASE WHEN x.need + {buffer} - {p} <= 0 THEN {p} ELSE "
            f"CAST({p} + greatest(ceil((x.need + {buffer} - {p}) / {inc}) * {inc}, {min_move}) AS {STATE}) END")
    give_back = (f"CASE WHEN {excess} - {buffer} < {min_move} THEN {p} "
                 f"WHEN {recall} < {min_move} THEN {p} ELSE "
                 f"CAST(greatest({p} - greatest(floor({recall} / {inc}) * {inc}, {min_move}), {buffer}) AS {STATE}) END")
    return f"CASE WHEN {excess} < 0 THEN {post} ELSE {give_back} END"


def collateral_report(report_days: DataFrame, exposure: DataFrame, pnl: DataFrame,
                      keys: list[str], date_col: str = "report_date",
                      exposure_col: str = "exposure", pnl_col: str = "pnl",
                      buffer: int = BUFFER, inc: int = MOVE_INCREMENT, min_move: int = MIN_MOVE,
                      initial_posted: int = INITIAL_POSTED, block: int = BLOCK_DAYS) -> DataFrame:
    """D07.  ``report_days``: (keys…, report_date) — every business day to
    report per key.  ``exposure``/``pnl``: facts at any grain ≥ (key, date);
    they are aggregated to day grain first (B05).

    Per day: IM = 5 % × exposure, VM = Σ pnl (0 when absent),
    need = IM − VM, excess = posted − need; the next day's posted follows
    the post / recall policy, sizing recalls against tomorrow's need (W16).
    """
    e = exposure.groupBy(*keys, date_col).agg(F.sum(exposure_col).alias("_exp"))
    p = pnl.groupBy(*keys, date_col).agg(F.sum(pnl_col).alias("_vm"))
    s = (report_days.select(*keys, date_col)
         .join(e, [*keys, date_col], "left").join(p, [*keys, date_col], "left"))
    im = (F.coalesce(F.col("_exp"), F.lit(0)).cast("decimal(20,2)")
          * F.lit(IM_RATE).cast("decimal(3,2)")).cast(STATE)
    vm = F.coalesce(F.col("_vm"), F.lit(0)).cast("decimal(20,2)").cast(STATE)
    s = s.withColumn("_im", im).withColumn("_vmv", vm).withColumn("need", (F.col("_im") - F.col("_vmv")).cast(STATE))
    s = next_day_value(s, keys, date_col, "need", "need_next")
    # one array per key, bounded by the number of report days of that key
    series = s.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        F.col(date_col).alias("d"), "need", "need_next", "_im", "_vmv"))).alias("ser"))
    # a first fold carries only the amount from block to block, a second one
    # lists it day by day within each block: no history longer than a block or
    # than the number of blocks is ever copied
    blocks = series.select(*keys, F.expr(
        f"transform(sequence(0, cast((size(ser) - 1) div {block} as int)), i -> slice(ser, i * {block} + 1, {block}))").alias("blocks"))
    history = f"CAST(array() AS ARRAY<{STATE}>)"
    starts = (f"aggregate(blocks, named_struct('p', CAST({initial_posted} AS {STATE}), 'h', {history}), "
              f"(acc, b) -> named_struct('p', aggregate(b, acc.p, (p, x) -> {_step_sql(buffer, inc, min_move, 'p')}), "
              f"'h', concat(acc.h, array(acc.p))), acc -> acc.h)")
    fold = (f"aggregate(b.s, named_struct('p', b.start, 'h', {history}), "
            f"(acc, x) -> named_struct('p', {_step_sql(buffer, inc, min_move)}, "
            f"'h', concat(acc.h, array(acc.p))), acc -> acc.h)")
    each = blocks.select(*keys, F.explode(F.arrays_zip(F.col("blocks").alias("s"), F.expr(starts).alias("start"))).alias("b"))
    folded = each.select(*keys, F.inline(F.arrays_zip(F.col("b.s").alias("s"), F.expr(fold).alias("posted"))))
    x = folded.select(*keys, F.col("s.d").alias(date_col), F.col("s._im").alias("im"),
                      F.col("s._vmv").alias("vm"), F.col("s.need").alias("need"), "posted")
    im2 = F.round(-F.col("im"), 2)
    vm2 = F.round(F.col("vm"), 2)
    return x.select(
        *keys, date_col,
        im2.cast("double").alias("initial_margin"),
        vm2.cast("double").alias("variation_margin"),
        (im2 + vm2).cast("double").alias("collateral_required"),
        F.round(F.col("posted"), 2).cast("double").alias("collateral_posted"),
        F.round(F.col("posted") - F.col("need"), 2).cast("double").alias("excess_deficit"),
    )


def with_positions(report: DataFrame, legs: DataFrame, keys: list[str], date_col: str = "report_date") -> DataFrame:
    """The report's latest two dates per key with the two portfolio figures of
    the KPI cards: ``total_portfolio`` (Σ size of the legs active that day)
    and ``open_positions`` (distinct trades).  The legs are read once, against
    two dates per key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(date_col))
    last = report.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2).drop("_r")
    dates = last.select(*keys, F.col(date_col).alias("_d"))
    active = legs.select(*keys, "trade_id", "trade_date", "value_date", "trade_size_usd").join(dates, keys) if keys else \
        legs.select("trade_id", "trade_date", "value_date", "trade_size_usd").join(
            F.broadcast(dates), F.col("_d") >= F.col("trade_date"))     # two rows
    active = active.filter((F.col("trade_date") <= F.col("_d")) & (F.col("_d") < F.col("value_date")))
    stats = active.groupBy(*keys, F.col("_d").alias(date_col)).agg(
        F.sum("trade_size_usd").cast("double").alias("total_portfolio"), F.count_distinct("trade_id").cast("double").alias("open_positions"))
    out = last.join(stats, [*keys, date_col], "left")
    return out.fillna(0.0, ["total_portfolio", "open_positions"])


def collateral_snapshot(report: DataFrame, keys: list[str], date_col: str = "report_date",
                        measures: list[str] | None = None) -> DataFrame:
    """Each measure at the latest date and the previous date with
    data, plus the difference, one row per key."""
    measures = measures or REPORT_COLUMNS[1:]
    w = Window.partitionBy(*keys).orderBy(F.desc(date_col))
    ranked = report.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
    aggs = [F.max(F.when(F.col("_r") == 1, F.col(date_col))).alias("latest_date"),
            F.max(F.when(F.col("_r") == 2, F.col(date_col))).alias("previous_date")]
    for m in measures:
        cur = F.max(F.when(F.col("_r") == 1, F.col(m)))
        prev = F.max(F.when(F.col("_r") == 2, F.col(m)))
        aggs += [cur.alias(f"{m}_latest"), prev.alias(f"{m}_previous"),
                 (F.coalesce(cur, F.lit(0.0)) - F.coalesce(prev, F.lit(0.0))).alias(f"{m}_change")]
    return ranked.groupBy(*keys).agg(*aggs)
