"""D05 limit_utilisation (J11 + J17 + A09 + A13) and D10
capacity_eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.functions import money as M
from tesoro.functions import text as T
from tesoro.operators.asof import as_of_expand

# Fixed values that must equal the reference's policy.
WARN_LEVEL = 0.75
BREACH_LEVEL = 1.00
HEADROOM = 1.1      # capacity a bank must have, as a multiple of the trade


def limit_schedule(reviews: DataFrame, business_days: DataFrame, calendar_end,
                   bank_col: str = "bank_id", effective_col: str = "effective_date",
                   limit_col: str = "credit_limit_usd") -> DataFrame:
    """The credit limit in force on each business day, from sparse
    dated reviews (backward, inclusive: a review counts from its own day)."""
    base = reviews.select(bank_col, effective_col, limit_col)
    out = as_of_expand(base, business_days, [bank_col], effective_col, calendar_end, "as_of_date")
    return out.select("as_of_date", bank_col, limit_col)


def limit_utilisation(reviews: DataFrame, exposure: DataFrame, business_days: DataFrame,
                      calendar_end, bank_col: str = "bank_id",
                      effective_col: str = "effective_date",
                      limit_col: str = "credit_limit_usd", exposure_col: str = "exposure",
                      exposure_date_col: str = "report_date") -> DataFrame:
    """One row per (as_of_date, bank) of the limit schedule with
    exposure (J03 default 0), available = round(limit − exposure, 2),
    utilisation (A09: 0 when the limit is 0/NULL) and warn/breach flags
    (A13, strict ``>``)."""
    sched = limit_schedule(reviews, business_days, calendar_end, bank_col, effective_col, limit_col)
    exp = exposure.select(bank_col, F.col(exposure_date_col).alias("as_of_date"),
                          F.col(exposure_col).alias("_exp"))
    j = sched.join(exp, [bank_col, "as_of_date"], "left")
    exp_dec = F.coalesce(F.col("_exp").cast(M.MONEY), F.lit(0).cast(M.MONEY))
    lim = F.col(limit_col).cast("double")
    util = F.coalesce(M.safe_divide(exp_dec.cast("double"), lim), F.lit(0.0))
    return j.select(
        "as_of_date", bank_col,
        lim.alias("credit_limit_usd"),
        exp_dec.cast("double").alias("counterparty_exposure_usd"),
        (F.col(limit_col).cast(M.MONEY) - exp_dec).cast("double").alias("limit_available_usd"),
        util.alias("utilisation"),
        (util > WARN_LEVEL).alias("is_warning"),
        (util > BREACH_LEVEL).alias("is_breach"),
    )


def utilisation_text(limits: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Counts above the warning / breach levels with the display texts."""
    g = limits.groupBy(*(group_cols or []))
    out = g.agg(F.count_if(F.col("utilisation") > WARN_LEVEL).alias("n_warning"),
                F.count_if(F.col("utilisation") > BREACH_LEVEL).alias("n_breach"))
    return (out
            .withColumn("warning_text", F.when(F.col("n_warning") > 0, F.concat(
                F.col("n_warning").cast("string"), F.lit(T.WARN_TEXT))).otherwise(F.lit(T.WARN_NONE_TEXT)))
            .withColumn("breach_text", F.when(F.col("n_breach") > 0, F.concat(
                F.col("n_breach").cast("string"), F.lit(T.BREACH_TEXT))).otherwise(F.lit(T.BREACH_NONE_TEXT))))


def capacity_eligibility(trades: DataFrame, limits: DataFrame, banks: DataFrame, business_days: DataFrame,
                         trade_col: str = "trade_id", bank_col: str = "bank_id", date_col: str = "trade_date",
                         size_col: str = "trade_size_usd", headroom: float = HEADROOM) -> DataFrame:
    """Every trade against every bank on the trade's (business) date:
    remaining = max(limit − exposure, 0), eligible if remaining ≥ headroom ×
    trade size, weight = remaining / Σ remaining over eligible banks (W14).
    ``has_limit`` is false where the bank has no limit row that day (before
    its first review): nothing remains and it is not eligible.

    ``limits`` is the D05 output (one row per bank and day).  It is reduced to
    one array of banks per day, so a trade meets its day once and the weight
    is array work: no window over trades.
    """
    calendar = business_days.agg(F.collect_list(date_col)).scalar()   # one value, bounded by the calendar
    days = banks.select(bank_col).distinct().withColumn("_days", calendar).select(bank_col, F.explode("_days").alias(date_col))
    lim = limits.select(F.col("as_of_date").alias(date_col), bank_col, "credit_limit_usd", "counterparty_exposure_usd")
    remaining = M.floor_at_zero(F.col("credit_limit_usd").cast("decimal(20,2)")
                                - F.col("counterparty_exposure_usd").cast("decimal(20,2)")).cast("decimal(20,2)")
    per_day = (days.join(lim, [date_col, bank_col], "left")
               .withColumn("has_limit", F.col("credit_limit_usd").isNotNull())
               .withColumn("remaining_usd", F.when(F.col("has_limit"), remaining).otherwise(F.lit(0).cast("decimal(20,2)")))
               .groupBy(date_col).agg(F.sort_array(F.collect_list(F.struct(bank_col, "has_limit", "remaining_usd"))).alias("_banks")))
    j = trades.select(trade_col, date_col, size_col).join(per_day, date_col)
    need = F.col(size_col).cast("decimal(20,2)") * F.lit(headroom).cast("decimal(3,1)")
    j = j.withColumn("_total", F.aggregate(
        "_banks", F.lit(0).cast("decimal(30,2)"),
        lambda acc, b: (acc + F.when(b["has_limit"] & (b["remaining_usd"] >= need), b["remaining_usd"]).otherwise(F.lit(0))).cast("decimal(30,2)")))
    out = j.select(trade_col, date_col, size_col, "_total", F.inline("_banks"))
    out = out.withColumn("eligible", F.col("has_limit") & (F.col("remaining_usd") >= need))
    weight = F.when(F.col("eligible"), M.safe_divide(F.col("remaining_usd").cast("double"), F.col("_total").cast("double")))
    return out.withColumn("weight", weight).drop("_total")
