"""Sinks and table maintenance (K01–K12) on plain Parquet/CSV folders.

There is no MERGE without a table format, so keyed upserts are composed
from an anti join and a union, and written so that a job never reads and
overwrites the same files: the merged rows for the touched partitions are
staged first, then swapped in with a dynamic partition overwrite.

Spark replaces the files of a plain folder by deleting the old ones first, so
a job lost in that moment leaves a part of it empty.  Where a table must be
whole at every moment, use :mod:`tesoro.sinks.versioned`, as the queries do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.session import scratch_path
from tesoro.sources.readers import path_exists


def csv_overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole CSV table."""
    df.write.mode("overwrite").option("header", True).csv(path)


#: Rows of a compressed CSV file, which only one task can read.
CSV_PART_ROWS = 1_000_000


def csv_parts(df: DataFrame, path: str) -> None:
    """A new CSV table in gzip files of bounded size: rows that repeat most of
    each other's text take a small part of their size on disk."""
    df.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", CSV_PART_ROWS).csv(path)


def per_day_partition_write(df: DataFrame, path: str, date_col: str = "date", fmt: str = "parquet",
                            mode: str = "append") -> None:
    """One folder per date (date=YYYY-MM-DD); readers prune by it.  Rows
    are rebalanced by date: small days share tasks, a hot day is split over
    several tasks and files."""
    w = df.hint("rebalance", F.col(date_col)).write.mode(mode).partitionBy(date_col)
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))


def replace_by_date(df: DataFrame, path: str, date_col: str = "date", fmt: str = "parquet") -> None:
    """Rewrite only the dates present in ``df`` (dynamic partition
    overwrite), so a rerun of the same days is idempotent."""
    (df.hint("rebalance", F.col(date_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).format(fmt).save(path))


def incremental_append(df: DataFrame, path: str, date_col: str):
    """The first run writes everything; later runs append only rows
    newer than the stored high-water mark (X04).  The mark is read from the
    table itself, so a retried run appends nothing twice.  Returns the mark
    used (None on the first run)."""
    mark = None
    if path_exists(df.sparkSession, path):
        mark = df.sparkSession.read.schema(df.schema).parquet(path).agg(F.max(date_col)).first()[0]
    rows = df if mark is None else df.filter(F.col(date_col) > F.lit(mark))
    rows.write.mode("append").parquet(path)
    return mark


def keep_last_per_key(df: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """One physical row per key, the most recent by ``recency``.

    A ``max_by`` aggregate rather than a ``row_number`` window: duplicates
    are reduced map-side, so a key holding a large share of the rows is
    never sorted in a single task.  Ties on ``recency`` are broken by the
    remaining columns, so the pick is deterministic across retries."""
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in recency], *[F.col(c) for c in others if c not in recency])
    picked = F.max_by(F.struct(*[F.col(c) for c in others]), rank).alias("_last")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others]).select(*df.columns)


def delete_duplicates_anti(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Rows with no later row of the same key — the reference's
    ``a.seq < b.seq`` self anti join, answered against the per-key maximum
    so that a hot key is never compared pair by pair."""
    latest = df.groupBy(*keys).agg(F.max(seq).alias("_max_seq"))
    cond = [df[k].eqNullSafe(latest[k]) for k in keys] + [df[seq] < latest["_max_seq"]]
    return df.join(latest, cond, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (empty = unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def upsert_by_key(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str],
                  partition_col: str | None = None, recency: list[str] | None = None) -> str:
    """Rows of ``incoming`` replace the rows with the same key (NULL
    equals NULL) in the table at ``path``; other rows stay.

    ``incoming`` is reduced to its last row per key (W03, by ``recency``) and
    staged once; the merged rows are staged too before they are swapped in,
    so a job never reads what it overwrites.  With ``partition_col`` only the
    touched partitions are merged and replaced, else the folder is rewritten
    in place.  A job lost while it swaps leaves what it swaps empty (the rows
    are in the staged folder); ``VersionedTable.upsert`` has no such moment."""
    fresh = _staged(spark, keep_last_per_key(incoming, keys, recency or []), "upsert-incoming")
    if not path_exists(spark, path):
        merged = fresh
    else:
        old = spark.read.parquet(path)
        if partition_col:
            old = old.join(fresh.select(partition_col).distinct(), partition_col, "left_semi")
        match = [old[k].eqNullSafe(fresh[k]) for k in keys]
        merged = _staged(spark, old.join(fresh, match, "left_anti").unionByName(fresh.select(*old.columns)), "upsert-merged")
    if partition_col:
        replace_by_date(merged, path, partition_col)
    else:
        merged.write.mode("overwrite").parquet(path)
    return path


def replace_by_source(spark: SparkSession, path: str, incoming: DataFrame, date_col: str, source_col: str) -> str:
    """All rows of a source file are replaced together: on the dates that
    ``incoming`` touches, rows of other files stay and rows of its files are
    replaced, so late files add to their day and a repeated load changes
    nothing."""
    fresh = _staged(spark, incoming, "source-incoming")
    merged = fresh
    if path_exists(spark, path):
        old = spark.read.parquet(path).join(fresh.select(date_col).distinct(), date_col, "left_semi")
        rest = old.join(fresh.select(source_col).distinct(), source_col, "left_anti")
        merged = _staged(spark, rest.select(*fresh.columns).unionByName(fresh), "source-merged")
    replace_by_date(merged, path, date_col)
    return path


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def create_table_if_absent(spark: SparkSession, path: str, schema) -> DataFrame:
    """An empty typed table when none exists; never touches data that
    is already there."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def add_column_with_default(df: DataFrame, column: str, default, dtype: str = "string") -> DataFrame:
    """A column added later defaults on old rows."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(default).cast(dtype))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default).cast(dtype)))


def insert_missing_rows(existing: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate rows whose key is not stored yet (J05 anti join)."""
    return candidates.join(existing.select(*keys).distinct(), keys, "left_anti")


def ordered_export(df: DataFrame, path: str, keys: list[str]) -> None:
    """A globally ordered export (range partitioned, sorted within)."""
    df.orderBy(*keys).write.mode("overwrite").parquet(path)
