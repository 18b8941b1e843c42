"""Exact distinct counts that merge.

A count of distinct ids can't be added up: an id that stands under two members
counts once for both together.  Here ids get dense numbers, and for every
member (a combination of dimension values) the set of its ids is kept as
bitmaps of 32,768 ids each.  The distinct count of any selection, roll-up or
span of days is the number of bits of a union, so facts are read once, for
the state, and never again for a selection.

Numbers follow the ids' first day, so ids that are used together share
bitmaps: a member has about as many bitmaps as its days have ids / 32,768.  Every
step is a partial aggregate; no id, day or member is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.operators.ranged import RANGE_ROWS, has_wide_groups, running
from tesoro.session import scratch_path

NUMBER, BUCKET, BITS, LEVEL = "id_number", "bucket", "bits", "level"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_ids(facts: DataFrame, id_col: str, day_col: str, known: DataFrame | None = None, rows: int = RANGE_ROWS) -> DataFrame:
    """(id, id_number): a dense number from 1 for every id, by its first day;
    NULL ids get none, ids without a day come first.

    With ``known``, the numbers given before, those stay and new ids follow.
    A day's ids are numbered in one task up to ``rows`` of them, by ranges of
    a hash beyond that; days are added up over one row a day."""
    ids = facts.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(day_col).alias("_day"))
    if known is not None:
        ids = ids.join(known.select(id_col), id_col, "left_anti")
    ids = _written(ids.withColumn("_hash", F.xxhash64(id_col)), "distinct-ids")
    wide = has_wide_groups(ids, ["_day"], rows)
    within = running(ids, ["_day"], F.col("_hash"), ["_hash", id_col], number="_in_day", rows=rows if wide else None)
    days = ids.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)   # one row a day of the calendar
    days = days.select(F.col("_day").alias("_d"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    start = 0 if known is None else known.agg(F.max(NUMBER)).first()[0] or 0
    new = (within.join(days, F.col("_day").eqNullSafe(F.col("_d")))
           .select(id_col, (F.lit(start) + F.col("_before") + F.col("_in_day")).cast("long").alias(NUMBER)))
    return new if known is None else known.select(id_col, NUMBER).unionByName(new)


def distinct_state(facts: DataFrame, id_col: str, members: list[str], numbers: DataFrame) -> DataFrame:
    """(members ..., bucket, bits): the ids of each member as bitmaps.
    Members are any columns, a day or month among them; NULL is a member.

    The narrow rows are dealt by member and bucket before any bitmap is made,
    so each bitmap is made once and whole: no task holds a part of most bitmaps
    and none are shuffled."""
    own = facts.where(F.col(id_col).isNotNull()).select(id_col, *members).distinct().join(numbers, id_col)
    dealt = own.select(*members, F.bitmap_bucket_number(NUMBER).alias(BUCKET),
                       F.bitmap_bit_position(NUMBER).alias("_bit")).repartition(*members, BUCKET)
    return dealt.groupBy(*members, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def _unions(state: DataFrame, by: list[str]) -> DataFrame:
    """One bitmap for each ``by`` and bucket."""
    return state.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def merge_states(first: DataFrame, *more: DataFrame) -> DataFrame:
    """One state of several over the same numbers, such as one a load."""
    members = [c for c in first.columns if c not in (BUCKET, BITS)]
    both = first
    for m in more:
        both = both.unionByName(m)
    return both.groupBy(*members, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(state: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    """The distinct ids of each ``by``, over all rows of ``state`` that a
    filter or join left; without ``by`` one row, 0 if there are none."""
    sets = state.groupBy(*by, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("_n"))
    return sets.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(out))


def distinct_cube(state: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    """The distinct ids of every roll-up of ``by``.  ``level`` tells a rolled
    up column (its bit is 1, the last column has the lowest) from a NULL
    member."""
    subsets = [[c for i, c in enumerate(by) if not level >> (len(by) - 1 - i) & 1] for level in range(1 << len(by))]
    # members that no roll-up tells apart are one bitmap before it is repeated
    sets = (_unions(state, by).groupingSets([[F.col(BUCKET), *[F.col(c) for c in s]] for s in subsets], BUCKET, *by)
            .agg(F.grouping_id().alias(LEVEL), F.bitmap_count(F.bitmap_or_agg(BITS)).alias("_n")))
    return sets.groupBy(*by, LEVEL).agg(F.sum("_n").cast("long").alias(out))


def distinct_rolling(state: DataFrame, day_col: str, step: int, periods: int, by: list[str] | None = None, out: str = "n") -> DataFrame:
    """The distinct ids of the ``periods`` periods of ``step`` days that end
    with each period of ``state``, whose ``day_col`` holds first days.  The
    bitmaps of a period are united first, and each union goes to the periods it
    counts in; no fact is repeated."""
    by = by or []
    periods_seen = state.select(day_col, *by).distinct()
    ahead = F.explode(F.transform(F.sequence(F.lit(0), F.lit(periods - 1)), lambda k: F.date_add(F.col(day_col), (k * step).cast("int"))))
    spread = _unions(state, [day_col, *by]).select(ahead.alias("_to"), *by, BUCKET, BITS)
    match = [F.col("_to") == F.col(f"_p_{day_col}"), *[F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in by]]
    seen = periods_seen.select(*[F.col(c).alias(f"_p_{c}") for c in [day_col, *by]])
    return distinct_counts(spread.join(seen, match, "left_semi").withColumnRenamed("_to", day_col), [day_col, *by], out)
