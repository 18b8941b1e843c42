"""As-of operators J11 limit_as_of_join, J10 (backward, inclusive).

No as-of join exists in the DataFrame API.  Sparse dated values (reviews)
are turned into validity intervals with ``lead`` over the *sparse* table,
then expanded onto the bounded calendar — the work is proportional to the
result, and no range predicate reaches the join planner.

Instants have no calendar to expand onto: ``as_of_join`` puts both sides into
one table, sorts it by key and time and carries the last right row forward.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.operators.ranged import RANGES, SLICE, shifted, with_slices
from tesoro.session import staged


def validity_intervals(df: DataFrame, keys: list[str], effective_col: str,
                       valid_to_col: str = "valid_to") -> DataFrame:
    """Each dated row is valid on [effective, next effective) for its key.

    Rows sharing a key and effective date: the last by the caller's order
    is not defined, so callers must deduplicate first (W03).
    """
    w = Window.partitionBy(*keys).orderBy(effective_col)
    return df.withColumn(valid_to_col, F.lead(effective_col).over(w))


def as_of_expand(df: DataFrame, business_days: DataFrame, keys: list[str], effective_col: str,
                 calendar_end, date_col: str = "as_of_date") -> DataFrame:
    """For every business day from a row's effective date until the next
    row of the same key (or ``calendar_end``), emit the row's values."""
    iv = validity_intervals(df, keys, effective_col, "_valid_to")
    end = F.coalesce(F.date_sub(F.col("_valid_to"), 1), F.lit(calendar_end).cast("date"))
    out = (iv.filter(end >= F.col(effective_col))
           .withColumn(date_col, F.explode(F.sequence(F.col(effective_col), end))))
    out = out.join(business_days, date_col, "left_semi")
    return out.drop("_valid_to")


def micros(df: DataFrame, col: str):
    """Microseconds of a date or timestamp column, the same in every session
    time zone for values without one."""
    kind = dict(df.dtypes)[col]
    if kind == "timestamp":
        return F.unix_micros(col)
    if kind == "date":
        return F.unix_date(col).cast("long") * 86_400_000_000
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{col}`)")


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
               values: dict[str, str], tie: list[str] | None = None, inclusive: bool = True,
               tolerance: int | None = None, rows: int | None = None, ranges: int = RANGES) -> DataFrame:
    """J10, J11 on timestamps: every row of ``left`` with the ``values`` (out:
    column) of the last row of ``right`` with the same keys at or before its
    time; ``inclusive=False``: before its time.  ``tolerance``: that row is at
    most so many seconds older.

    Both sides share one shuffle by key and one sort, so the work is linear in
    the rows however many right rows a key has.  Without ``rows`` a key is one
    window.  With it, keys of more than ``rows`` rows are cut into ranges of
    time that run in parallel, each starting from the last right row of the
    ranges before it; the tagged rows are then written once, as they are read
    for the counts, the cuts, the carried rows and the result.

    Defined results: right rows equal in keys and time count as one, the
    largest by ``tie`` and then by the values; a null key or time on the left
    finds nothing, on the right is never found; repeated left rows stay."""
    group = [f"_g{i}" for i in range(len(keys))]
    known = lambda t: F.expr("true") if not t else F.array_position(F.array(*[F.col(c).isNull() for c in t]), True) == 0
    keyed = [F.col(k).alias(g) for k, g in zip(keys, group)]
    fields = [F.col(right_time).alias("_at"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tie or [])],
              *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values.values())]]
    own = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row")
    l_rows = left.select(*keyed, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), own)
    r_rows = (right.where(known([*keys, right_time])).groupBy(*keyed, F.col(right_time).alias("_t"))
              .agg(F.max(F.struct(*fields)).alias("_last")).withColumn("_side", F.lit(0 if inclusive else 2)))
    no_key = ~known([*group, "_t"])
    both = l_rows.where(~no_key).unionByName(r_rows, allowMissingColumns=True)
    upto = lambda part, *order: Window.partitionBy(*part).orderBy(*order)
    if rows is None:
        w = upto(group, "_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn("_last", F.last("_last", ignorenulls=True).over(w))
    else:
        both = staged(both)
        both = staged(with_slices(both, group, micros(both, "_t"), rows, ranges).drop("_cuts"))
        ends = both.groupBy(*group, SLICE).agg(F.max("_last").alias("_end"))      # the time leads the struct
        earlier = upto(group, SLICE).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
        w = upto([*group, SLICE], "_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
        found = shifted(both.withColumn("_last", F.last("_last", ignorenulls=True).over(w)), group, ends)
        found = found.withColumn("_last", F.coalesce("_last", "_carried"))
    found = found.where("_side = 1").select("_row", "_t", "_last")
    found = found.unionByName(l_rows.where(no_key).select("_row", "_t"), allowMissingColumns=True)
    if tolerance is not None:
        young = F.expr("timestampdiff(MICROSECOND, _last._at, _t)") <= F.lit(tolerance * 1_000_000)
        found = found.withColumn("_last", F.when(young, F.col("_last")))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in left.columns],
                        *[F.col(f"_last._v{i}").alias(out) for i, out in enumerate(values)])
