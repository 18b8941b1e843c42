"""Session helpers: building a local session for tests/bench and locating the
shared work folder (``spark.checkpoint.dir``) used for staged tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Partition counts are sized for the local
# test box; on a cluster the session's own values win (see ``build_session``).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tesoro", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark (local mode)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TESORO_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem).  A session on a local master that has none (tests) gets one
    under the system temp folder; on a cluster a machine-local folder would
    lose data, so a missing setting is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    jdir = spark.sparkContext.getCheckpointDir()
    if jdir:
        return jdir
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set; on {master or 'a cluster'} it must name a shared folder")
    local = tempfile.mkdtemp(prefix="tesoro-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused sub-folder of the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a reused intermediate as Parquet to the shared work folder: cuts
    its lineage, survives executor loss, and readers prune its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
