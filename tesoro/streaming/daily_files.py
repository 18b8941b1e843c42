"""Z01 daily_file_stream: new daily files landed in a folder are loaded
into a date-partitioned table, rerun-safe.

Structured Streaming's file source remembers which files it has read in
its checkpoint, so a restart (or a lost executor) neither skips nor
re-loads a file; each micro-batch is merged into the table by source file
(a late file adds to its day, a file loaded again replaces its own rows) or
by keyed upsert (K05), both idempotent, so a batch replayed after a failure
leaves the same table.  ``availableNow`` drains the folder and stops —
the batch-pipeline cadence of the reference — while the same query runs
continuously with a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.sinks.versioned import VersionedTable
from tesoro.sinks.writers import replace_by_source, upsert_by_key

SOURCE_COL = "source_file"


def daily_file_stream(spark: SparkSession, landing: str, schema, target: str | VersionedTable, checkpoint: str,
                      date_col: str = "date", keys: list[str] | None = None, fmt: str = "csv",
                      available_now: bool = True, processing_time: str = "1 minute",
                      partition_col: str | None = None, partition_expr=None):
    """Start the stream; with ``available_now`` block until the landed files
    are loaded.  Without ``keys`` rows carry their ``source_file`` and are
    merged by it; ``keys`` switches the sink to a keyed upsert;
    ``partition_col``/``partition_expr`` give the upsert table a coarser
    layout (e.g. monthly folders) than one folder per day.  A ``target`` that
    is a versioned table sees a batch whole or not at all; a plain folder is
    swapped day by day."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(landing)
    if not keys:
        stream = stream.select("*", F.col("_metadata.file_path").alias(SOURCE_COL))

    def load(batch: DataFrame, epoch_id: int) -> None:
        if keys:
            part = partition_col or date_col
            if partition_expr is not None:
                batch = batch.withColumn(part, partition_expr)
            if isinstance(target, VersionedTable):
                target.upsert(batch, keys)
            else:
                upsert_by_key(batch.sparkSession, target, batch, keys, partition_col=part)
        elif isinstance(target, VersionedTable):
            target.replace_source(batch, SOURCE_COL)
        else:
            replace_by_source(batch.sparkSession, target, batch, date_col, SOURCE_COL)

    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
