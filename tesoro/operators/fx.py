"""FX history: normalisation (P01–P05, F01, F02), keep-last merge (W03,
J18), calendar grid (J06, J07), gap fill (W01, W02) with quality flags
(D03), fetch planning (D04, J04, F04), late correction (X05), conversion
(J12), and the NULL gate (Q01, A17).

Raw sources can be fact-sized; everything after the keep-last merge is
keyed by (date, currency), i.e. bounded by calendar × currencies.  The
merge itself is a ``max_by`` aggregate, so a hot (date, currency) key is
pre-reduced map-side instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Fixed values that must equal the reference's output.
QUALITY_RAW = "raw"
QUALITY_FILLED = "filled"
RECENT_FILLED_LOOKBACK_DAYS = 7
FX_COLUMNS = ["date", "currency", "fx_to_usd", "fx_quality_flag"]
FX_TYPES = {"date": "date", "currency": "string", "fx_to_usd": "double", "fx_quality_flag": "string"}


def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip + lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def add_missing_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Required columns that are absent become typed NULLs."""
    for c, t in types.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def lenient_date(c: Column) -> Column:
    """Unparsable text → NULL (ANSI mode would raise on a plain cast)."""
    return F.coalesce(F.try_to_timestamp(c.cast("string")).cast("date"),
                      F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd")).cast("date"))


def lenient_double(c: Column) -> Column:
    """Unparsable number → NULL."""
    return c.try_cast("double")


def canonical_key(c: Column) -> Column:
    """Upper + trim."""
    return F.upper(F.trim(c.cast("string")))


def whitelist_flag(c: Column, allowed=(QUALITY_RAW, QUALITY_FILLED), default=QUALITY_RAW) -> Column:
    """Lower-cased flag if allowed, else the default (NULL included)."""
    low = F.lower(c.cast("string"))
    return F.when(low.isin(*allowed), low).otherwise(F.lit(default))


def normalise_fx_frame(df: DataFrame, targets=None, keep: list[str] | None = None) -> DataFrame:
    """P01–P05 + F01 (drop NULL keys) + F02 (currency in target list).

    ``targets``: a list of codes, or a one-column DataFrame of codes (then a
    broadcast semi join — a currency list is a small dimension).
    ``keep``: extra columns carried through (ordering keys for keep-last).
    """
    keep = keep or []
    df = normalise_headers(df)
    df = add_missing_columns(df, FX_TYPES)
    out = df.select(
        (F.col("date") if dict(df.dtypes)["date"] == "date" else lenient_date(F.col("date"))).alias("date"),
        canonical_key(F.col("currency")).alias("currency"),
        F.col("fx_to_usd").try_cast("double").alias("fx_to_usd"),
        whitelist_flag(F.col("fx_quality_flag")).alias("fx_quality_flag"),
        *keep)
    out = out.dropna(subset=["date", "currency"])
    if targets is None:
        return out
    if isinstance(targets, DataFrame):
        codes = targets.select(canonical_key(F.col(targets.columns[0])).alias("currency"))
        return out.join(codes, "currency", "left_semi")
    return out.filter(F.col("currency").isin([str(t).strip().upper() for t in targets]))


def keep_last(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """One row per key, the last by ``order`` (ties broken by the
    values themselves, so the pick is deterministic).  A ``max_by``
    aggregate: partial aggregation collapses duplicates before the shuffle."""
    rank = F.struct(*[F.col(c) for c in order], *[F.col(v) for v in values])
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), rank).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def merge_sources(sources: list[DataFrame], order: list[str] | None = None) -> DataFrame:
    """Union sources given in precedence order (later wins per key),
    then keep-last on (date, currency)."""
    order = order or []
    tagged = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    u = tagged[0]
    for s in tagged[1:]:
        u = u.unionByName(s, allowMissingColumns=True)
    return keep_last(u, ["date", "currency"], ["_src", *order], ["fx_to_usd", "fx_quality_flag"])


def currency_grid(currencies: DataFrame, start, end, currency_col: str = "currency") -> DataFrame:
    """Every (date, currency) of the calendar.  Generated per currency
    row with ``explode(sequence)`` — the currency list is a dimension, so
    this never joins two large inputs."""
    return currencies.select(F.col(currency_col).alias("currency"),
                             F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))


def fill_history(grid: DataFrame, merged: DataFrame, base_currency: str) -> DataFrame:
    """D03 core: re-index on the grid (J07), force the base currency to 1.0
    (P11), forward-fill then back-fill per currency (W01, W02; Trap2 fixed),
    flag cells that were empty and got a value as ``filled``."""
    j = grid.join(merged, ["date", "currency"], "left")
    missing = F.col("fx_to_usd").isNull()
    base = F.col("currency") == F.lit(base_currency)
    j = j.withColumn("_missing", missing).withColumn(
        "fx_to_usd", F.when(base, F.lit(1.0)).otherwise(F.col("fx_to_usd")))
    w = Window.partitionBy("currency").orderBy("date")
    ff = F.last("fx_to_usd", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    j = j.withColumn("fx_to_usd", ff)
    bf = F.first("fx_to_usd", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    j = j.withColumn("fx_to_usd", bf)
    flag = (F.when(base, F.lit(QUALITY_RAW))
            .when(F.col("_missing") & F.col("fx_to_usd").isNotNull(), F.lit(QUALITY_FILLED))
            .otherwise(whitelist_flag(F.col("fx_quality_flag"))))
    return j.select("date", "currency", "fx_to_usd", flag.alias("fx_quality_flag"),
                    F.col("_missing").alias("missing_before_fill"))


def fx_history(sources: list[DataFrame], currencies: DataFrame, base_currency: str, start, end,
               order: list[str] | None = None) -> DataFrame:
    """(date, currency, fx_to_usd, fx_quality_flag, missing_before_fill)."""
    merged = merge_sources(sources, order)
    return fill_history(currency_grid(currencies, start, end), merged, base_currency)


def missing_on_business_days(history: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per currency, NULL rates on business days before and after fill."""
    bd = calendar.filter("is_business_day").select(F.col("calendar_date").alias("date"))
    h = history.join(bd, "date", "left_semi")
    return h.groupBy("currency").agg(
        F.count_if(F.col("missing_before_fill")).alias("missing_before_fill"),
        F.count_if(F.col("fx_to_usd").isNull()).alias("missing_after_fill"))


def assert_no_missing(history: DataFrame, calendar: DataFrame) -> None:
    """Q01 as a gate: raise, listing currency=count, if a business day still
    has no rate after filling."""
    bad = (missing_on_business_days(history, calendar).filter(F.col("missing_after_fill") > 0)
           .orderBy("currency").collect())   # at most one row per currency
    if bad:
        raise RuntimeError("Missing FX values remain on business days after fill: " +
                           ", ".join(f"{r.currency}={r.missing_after_fill}" for r in bad))


def missing_grid(stored: DataFrame, currencies: DataFrame, calendar: DataFrame, start, end) -> DataFrame:
    """Expected (business day × currency) keys absent from
    ``stored`` (a key with a NULL rate counts as present, as in the
    reference).  Expected keys are generated per currency, then a left anti
    join removes the present ones."""
    bd = calendar.filter("is_business_day").select(F.col("calendar_date").alias("date"))
    expected = currency_grid(currencies, start, end).join(bd, "date", "left_semi")
    present = stored.select("date", "currency").distinct()
    return expected.join(present, ["date", "currency"], "left_anti")


def gap_plan(stored: DataFrame, currencies: DataFrame, calendar: DataFrame, history_start, as_of,
             lookback: int = RECENT_FILLED_LOOKBACK_DAYS) -> DataFrame:
    """One row — latest stored date, first business day with a missing
    key, first recently-filled date, and fetch_start = the least of
    (latest + 1, first missing, first recently filled)."""
    miss = missing_grid(stored, currencies, calendar, history_start, as_of)
    recent = recent_filled_dates(stored, as_of, lookback)
    # one aggregate row; the other figures are scalar subqueries (no joins)
    row = stored.agg(F.max("date").alias("latest_date")).select(
        "latest_date",
        miss.agg(F.min("date")).scalar().alias("first_missing_business_day"),
        miss.agg(F.count(F.lit(1))).scalar().alias("missing_rows"),
        recent.agg(F.min("date")).scalar().alias("first_recent_filled"),
        recent.agg(F.count(F.lit(1))).scalar().alias("recent_filled_days"))
    nxt = F.date_add(F.coalesce(F.col("latest_date"), F.date_sub(F.lit(history_start).cast("date"), 1)), 1)
    return row.withColumn("fetch_start", F.least(nxt, F.col("first_missing_business_day"),
                                                 F.col("first_recent_filled")))


def recent_filled_dates(stored: DataFrame, as_of, lookback: int = RECENT_FILLED_LOOKBACK_DAYS) -> DataFrame:
    """distinct dates flagged ``filled`` within ``lookback`` days of as_of."""
    lo = F.date_sub(F.lit(as_of).cast("date"), lookback)
    return (stored.filter((F.col("fx_quality_flag") == QUALITY_FILLED) & (F.col("date") >= lo))
            .select("date").distinct())


def late_corrections(stored: DataFrame, fresh: DataFrame, as_of, lookback: int = RECENT_FILLED_LOOKBACK_DAYS) -> DataFrame:
    """Provisional (``filled``) stored rows within ``lookback`` days of
    as_of for which a fresh rate exists, with that rate and flag raw."""
    recent = stored.filter((F.col("fx_quality_flag") == QUALITY_FILLED)
                           & (F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), lookback))).select("date", "currency")
    new = fresh.filter(F.col("fx_to_usd").isNotNull()).select("date", "currency", "fx_to_usd")
    return recent.join(new, ["date", "currency"]).withColumn("fx_quality_flag", F.lit(QUALITY_RAW))


def convert_to_usd(facts: DataFrame, rates: DataFrame, amount_col: str, out_col: str,
                   date_col: str = "date", currency_col: str = "currency") -> DataFrame:
    """Amount / fx_to_usd looked up on (date, currency) (Trap1: the
    stored quote is USD→ccy); no rate → NULL, which a later sum skips."""
    r = rates.select(F.col("date").alias(date_col), F.col("currency").alias(currency_col), "fx_to_usd")
    j = facts.join(r, [date_col, currency_col], "left")
    return j.withColumn(out_col, F.try_divide(F.col(amount_col).cast("double"), F.col("fx_to_usd")))
