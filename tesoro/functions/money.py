"""Numeric helpers (N-S1 … N-S5).  Money is carried as DECIMAL(18,2) so sums
are exact and independent of evaluation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WIDE_MONEY = "decimal(38,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast to DECIMAL(18,2) (half-up rounding on the cast)."""
    return _c(c).cast(MONEY)


# N-S1 round_money
def round2(c) -> Column:
    return F.round(_c(c), 2)


def round6(c) -> Column:
    return F.round(_c(c), 6)


# N-S2 round_to_step
def round_to_step(c, step: float) -> Column:
    return F.round(_c(c) / F.lit(step)) * F.lit(step)


def ceil_to_step(c, step: float) -> Column:
    return F.ceil(_c(c) / F.lit(step)) * F.lit(step)


def floor_to_step(c, step: float) -> Column:
    return F.floor(_c(c) / F.lit(step)) * F.lit(step)


# N-S3 clamp
def clamp(c, lo=None, hi=None) -> Column:
    out = _c(c)
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return out


def floor_at_zero(c) -> Column:
    return F.greatest(_c(c), F.lit(0))


# N-S4 abs_sign
def sign_class(c) -> Column:
    return F.signum(_c(c)).cast("int")


# N-S5 safe_divide
def safe_divide(num, den, default=None) -> Column:
    """num / den; NULL (or ``default``) when den is 0 or NULL."""
    q = F.try_divide(_c(num), _c(den))
    q = F.when(_c(den) == 0, F.lit(None)).otherwise(q)
    return q if default is None else F.coalesce(q, F.lit(default))
