"""Running sums and row numbers within groups of any size.

A window over a whole group is one sort in one task.  Here a group with more
than ``rows`` rows is cut into ranges of its leading order column, by
approximate quantiles: sketches that are merged from all tasks, so no task
sees the whole group.  Each range is summed or numbered on its own, in
parallel, and shifted by the totals of the ranges before it.  Ranges follow the
order, so where they are cut changes no result.  Rows equal in the leading
column share a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups with more rows are cut into ranges.
RANGE_ROWS = 1_000_000
#: Ranges of such a group.
RANGES = 64
SLICE = "_slice"


def has_wide_groups(df: DataFrame, group: list[str], rows: int = RANGE_ROWS) -> bool:
    """Whether a group has more than ``rows`` rows (one counting pass)."""
    return bool(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows).take(1))


def with_slices(df: DataFrame, group: list[str], lead: Column, rows: int = RANGE_ROWS, ranges: int = RANGES) -> DataFrame:
    """``df`` with the number of each row's range of ``lead`` (a number,
    ascending in the wanted order); 0 throughout in groups of up to ``rows``."""
    led = df.withColumn("_lead", lead)
    wide = led.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows).select(*group)
    cuts = (led.select(*group, "_lead").join(wide, group, "left_semi").groupBy(*group)
            .agg(F.percentile_approx("_lead", [i / ranges for i in range(1, ranges)], 10_000).alias("_cuts")))
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_lead")))
    return led.join(cuts, group, "left").withColumn(SLICE, F.when(F.col("_cuts").isNull(), 0).otherwise(below)).drop("_lead", "_cuts")


def shifted(df: DataFrame, group: list[str], totals: DataFrame) -> DataFrame:
    """``df`` joined with one row of ``totals`` a (group, range), NULL equal to
    NULL."""
    keys = [*group, SLICE]
    right = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in totals.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(right, match, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def running(df: DataFrame, group: list[str], lead: Column, order: list, sums: dict[str, str] | None = None,
            number: str | None = None, rows: int | None = None, ranges: int = RANGES) -> DataFrame:
    """``df`` with, for each ``sums`` item (out: column), the sum of the column
    over the group's earlier rows, and the row's ``number`` from 1.

    Without ``rows`` by one window a group; with it by ranges.  ``df`` is then
    read for the counts, the quantiles, the totals and the rows, so pass a
    written table.  ``lead`` is a number that rises with ``order``."""
    sums = sums or {}
    before = (Window.unboundedPreceding, -1)

    def in_windows(b, keys):
        w = Window.partitionBy(*keys).orderBy(*order)
        for out, c in sums.items():
            b = b.withColumn(out, F.coalesce(F.sum(c).over(w.rowsBetween(*before)), F.lit(0)))
        return b.withColumn(number, F.row_number().over(w).cast("long")) if number else b

    if rows is None:
        return in_windows(df, group)
    b = with_slices(df, group, lead, rows, ranges)
    totals = b.groupBy(*group, SLICE).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(*before)
    for c in ["_rows", *[f"_t_{out}" for out in sums]]:
        totals = totals.withColumn(f"_b{c}", F.coalesce(F.sum(c).over(earlier), F.lit(0))).drop(c)
    out = shifted(in_windows(b, [*group, SLICE]), group, totals)
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.col(f"_b_t_{name}"))
    if number:
        out = out.withColumn(number, F.col(number) + F.col("_b_rows"))
    return out.drop(SLICE, "_b_rows", *[f"_b_t_{name}" for name in sums])
