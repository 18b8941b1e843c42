"""Incremental processing (X01, X03, X04) and quality gates (Q02, Q03,
Q05, Q06).  Every check returns a small DataFrame (counts), so it can be
compared, logged or asserted on — nothing pulls facts to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, date_col: str) -> DataFrame:
    """One row, the max date (NULL when the table is empty)."""
    return df.agg(F.max(date_col).alias("high_water_mark"))


def independent_watermarks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Each dataset keeps its own mark."""
    parts = [df.agg(F.max(c).cast("date").alias("high_water_mark")).select(F.lit(name).alias("dataset"),
                                                                          "high_water_mark")
             for name, (df, c) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def incremental_slice(df: DataFrame, date_col: str, mark) -> DataFrame:
    """Only rows after the mark; everything when there is none."""
    return df if mark is None else df.filter(F.col(date_col) > F.lit(mark))


def not_null_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q02: NULL count per NOT NULL column (all zero = pass)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c) for c in columns]))).alias("column", "nulls"))


def exposure_within_limit(limits: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Q03: (bank, day) rows whose exposure exceeds limit + tolerance."""
    return limits.filter(F.col("counterparty_exposure_usd") > F.col("credit_limit_usd") + F.lit(tolerance))


def row_count(df: DataFrame, name: str) -> DataFrame:
    """Q06: the table is readable; its row count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
