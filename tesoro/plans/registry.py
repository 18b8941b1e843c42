"""Registry of named queries (one per operator ID of the survey) and their
DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.plans.bindings import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_TABLES: dict = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """One memoising loader per (application, directory, state of its files)
    so bindings that several queries share (calendar bounds) are computed
    once, but never outlive their session or tables that were rewritten."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
    state = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime")).first()
    key = (spark.sparkContext.applicationId, sf_dir, tuple(state))
    if key not in _TABLES:
        for old in [k for k in _TABLES if k[0] != key[0] or k[1] == sf_dir]:
            del _TABLES[old]
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


def query(name: str, oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens on import)."""
    from tesoro.plans import (q_calendar, q_positions, q_collateral, q_treasury, q_fx,  # noqa: F401
                              q_measures, q_booking, q_scalar, q_io, q_rules, q_distinct)
