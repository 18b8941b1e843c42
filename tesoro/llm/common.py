"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.session import scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared work folder and read it
    back: cuts the lineage with files every executor can see.  The shuffle
    files of the write are dropped when it ends; nothing reads them again."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) with null texts read as empty; any other
    column, whatever its name, is left behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def row_keys(docs: DataFrame, k1: str = "k1", k2: str = "k2") -> DataFrame:
    """docs with two columns, 128 bits that stand for id and text of a row."""
    doc, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({k1: F.xxhash64(doc, text), k2: F.xxhash64(text, F.lit(1), doc)})


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def map_rows(df: DataFrame, fn: Callable, ddl: str) -> DataFrame:
    """mapInArrow with plain rows out: ``fn(batches)`` yields lists of tuples
    in the order of ``ddl``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        import pyarrow as pa
        for rows in fn(batches):
            cols = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)

    return df.mapInArrow(run, ddl)


#: Rows of an edge table that make a task of their own.
EDGE_ROWS = 200_000


def smallest_labels(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of ``edges`` (long ids): (node, label) for every
    node of an edge to another, with ``label`` the smallest node reachable.

    Alternates large-star and small-star steps.  Both only group a node with
    its neighbourhood minimum: a partial aggregate, written as a table, and an
    equi join with it, so the rows of a hub can be split over tasks.  Every
    step is a written table, so a lost executor repeats one step; it has as
    many tasks as its edges fill, whatever the number of shuffle partitions.
    Ends when every component is a star around its smallest node.
    """
    e = stage(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
              .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    tasks = 1 + e.count() // EDGE_ROWS      # the edges never become more
    if len(e.inputFiles()) > tasks:
        e = stage(e.coalesce(tasks), name)
    while _open_nodes(e).coalesce(tasks).take(1):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")).coalesce(tasks), name)
        large = stage(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").distinct().coalesce(tasks), name)
        low2 = stage(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), name)
        small = (large.join(low2, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("s"))
            .select("s.*").where("u <> v").distinct())
        e = stage(small.coalesce(tasks), name)
    found = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())


def _open_nodes(e: DataFrame) -> DataFrame:
    """Nodes that keep edges (u, v), u > v, from being stars around the v."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)")


#: Upper-case ASCII letters become lower case, every other ASCII byte that is
#: neither a letter nor a digit becomes a space; other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in
    lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
