"""Tables published as versions: a write is seen whole or not at all.

Layout under the table's path::

    data/commit=<id>/[<partition column>=<value>/]part-*.parquet
    _versions/<number>.json        one manifest a version

A write goes to a commit folder of its own.  It becomes part of the table when
the manifest that names it is put in place by one rename that never replaces
another manifest; readers resolve the latest manifest (or one they name) to the
folders that are live.  A job that is lost before the rename leaves the table
as it was, and its folder is named by no manifest; the same call again gives
the same rows.  No job overwrites files another one may read, so rows need not
be staged before they replace those they were made from.

A manifest lists folders, not files: one entry a partition.  It also holds the
high-water marks of the loads that made the table, so a mark never runs ahead
of the rows or stays behind them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesoro.session import scratch_path
from tesoro.sinks.writers import keep_last_per_key


#: The folder of rows without a value of the partition column.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentCommit(RuntimeError):
    """Another writer published the next version first; run the load again."""


class _Files:
    """The few calls of the file system below a Spark session that manifests
    need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, file: str, text: str) -> bool:
        """Put a file in place by one rename; False if its name is taken."""
        folder, name = file.rsplit("/", 1)
        waiting = self.path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        out = self.fs.create(waiting, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), self.conf)
        options = self.jvm.org.apache.hadoop.fs.Options
        no_options = self.jvm.java.lang.reflect.Array.newInstance(getattr(options, "Rename").NONE.getClass(), 0)
        try:
            context.rename(waiting, self.path(file), no_options)
        except Exception as e:
            self.fs.delete(waiting, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


@dataclass
class Manifest:
    """``parts``: partition folder ('' without partitions) -> its commits."""
    version: int
    schema: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    def commits(self) -> set[str]:
        return {c for own in self.parts.values() for c in own}


class VersionedTable:
    """A Parquet table of versions at ``path``, in folders by
    ``partition_col`` if one is given."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str | None = None):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        self.files = _Files(spark, self.path)

    # --- reading ---------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.path}/_versions") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The latest manifest, or that of a version; None for a new table."""
        if version is None:
            version = max(self.versions(), default=None)
            if version is None:
                return None
        return Manifest(**json.loads(self.files.read(f"{self.path}/_versions/{version:08d}.json")))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version.  Filters on the partition column prune
        folders, and a commit that is live as a whole is one path."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self._rows(m).select(*T.StructType.fromJson(json.loads(m.schema)).names)

    def _rows(self, m: Manifest) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(m.schema))
        own: dict[str, list[str]] = {}
        for part, commits in m.parts.items():
            for c in commits:
                own.setdefault(c, []).append(part)
        data = f"{self.path}/data"
        paths = []
        for c, parts in sorted(own.items()):
            whole = parts == [""] or set(parts) == {n for n in self.files.names(f"{data}/commit={c}") if "=" in n}
            paths += [f"{data}/commit={c}"] if whole else [f"{data}/commit={c}/{p}" for p in sorted(parts)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths)

    def mark(self, dataset: str) -> dt.date | None:
        """The high-water mark of one dataset, from the manifest."""
        m = self.manifest()
        found = m and m.marks.get(dataset)
        return dt.date.fromisoformat(found) if found else None

    # --- writing ---------------------------------------------------------------

    def _commit(self, df: DataFrame, base: Manifest | None, keep, marks=None) -> int | None:
        """Write ``df`` to a commit of its own and publish it with the parts
        of ``base`` that ``keep(part, written parts)`` lets stay.  ``marks`` may
        be a function of the written parts; if it returns None, nothing is
        published and the commit goes."""
        version = base.version + 1 if base else 1
        commit = f"{version:08d}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.path}/data/commit={commit}"
        w = self._dealt(df) if self.partition_col else df
        w = w.write.mode("errorifexists").option("compression", "zstd")
        (w.partitionBy(self.partition_col) if self.partition_col else w).parquet(folder)
        written = [n for n in self.files.names(folder) if "=" in n] if self.partition_col else [""]
        if callable(marks):
            marks = marks(written)
            if marks is None:
                self.files.delete(folder)
                return None
        parts = {p: list(c) for p, c in (base.parts.items() if base else ()) if keep(p, written)}
        for p in written:
            parts.setdefault(p, []).append(commit)
        known = {**(base.marks if base else {}), **{k: v.isoformat() for k, v in (marks or {}).items() if v is not None}}
        self._publish(Manifest(version, df.schema.json(), parts, known))
        return version

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows of one folder together; folders by date a week together, as
        the days of a key that stand in a row then stay next to each other and
        shrink to a fraction when they are shuffled."""
        if not isinstance(df.schema[self.partition_col].dataType, T.DateType):
            return df.hint("rebalance", F.col(self.partition_col))
        week = f"_week_of_{self.partition_col}"
        return df.withColumn(week, F.trunc(self.partition_col, "week")).hint("rebalance", F.col(week)).drop(week)

    def _publish(self, m: Manifest) -> None:
        name = f"{self.path}/_versions/{m.version:08d}.json"
        if not self.files.put_new(name, json.dumps(m.__dict__, sort_keys=True)):
            raise ConcurrentCommit(name)

    def overwrite(self, df: DataFrame, order: list[str] | None = None) -> int:
        """All rows are replaced; with ``order`` by rows in a global
        order."""
        return self._commit(df.orderBy(*order) if order else df, self.manifest(), lambda part, written: False)

    def append(self, df: DataFrame, marks: dict[str, dt.date] | None = None) -> int:
        base = self.manifest()
        return self._commit(self._like(df, base), base, lambda part, written: True, marks)

    def replace_partitions(self, df: DataFrame, marks=None) -> int | None:
        """The partitions that ``df`` has rows of hold those rows only;
        others stay."""
        base = self.manifest()
        return self._commit(self._like(df, base), base, lambda part, written: part not in written, marks)

    def upsert(self, incoming: DataFrame, keys: list[str], recency: list[str] | None = None) -> int:
        """Rows of ``incoming`` (its last of a key, by ``recency``)
        replace the rows of the same key; NULL equals NULL.  With a partition
        column only the touched partitions are read and written; a key keeps
        its partition."""
        base = self.manifest()
        fresh = keep_last_per_key(self._like(incoming, base), keys, recency or [])
        merged = fresh
        if base:
            fresh = self._staged(fresh)
            old = self.read(base.version)
            if self.partition_col:
                old = old.join(fresh.select(self.partition_col).distinct(), self.partition_col, "left_semi")
            match = [old[k].eqNullSafe(fresh[k]) for k in keys]
            merged = old.join(fresh.select(*keys), match, "left_anti").select(*fresh.columns).unionByName(fresh)
        return self._commit(merged, base, lambda part, written: bool(self.partition_col) and part not in written)

    def replace_source(self, incoming: DataFrame, source_col: str) -> int:
        """All rows of a source are replaced together, wherever they
        stand.  A source that comes again without one of its former
        partitions loses its rows there; rows of other sources stay."""
        if not self.partition_col:
            raise ValueError("replace_source needs a partition column")
        base = self.manifest()
        fresh = self._like(incoming, base)
        if base is None:
            return self._commit(fresh, base, lambda part, written: False)
        fresh = self._staged(fresh)
        sources = fresh.select(source_col).distinct()
        part = F.regexp_extract("_metadata.file_path", r"/commit=[^/]+/([^/]+)/[^/]+$", 1)
        old = self._rows(base).withColumn("_part", part) if base.parts else self._rows(base).withColumn("_part", F.lit(""))
        # partition folders that hold rows of these sources: at most the folders of the manifest
        former = {unquote(r[0]) for r in old.join(sources, source_col, "left_semi").select("_part").distinct().collect()}
        dates = fresh.select(self.partition_col).distinct()
        touched = old.where(F.col("_part").isin(*sorted(former))) if former else old.limit(0)
        stay = touched.select(*fresh.columns).unionByName(
            (old.where(~F.col("_part").isin(*sorted(former))) if former else old).join(dates, self.partition_col, "left_semi").select(*fresh.columns))
        rest = stay.join(sources, source_col, "left_anti").select(*fresh.columns)
        return self._commit(rest.unionByName(fresh), base, lambda p, written: p not in written and p not in former)

    def load_newer(self, source: DataFrame, dataset: str, date_col: str, reopened: list[dt.date] | None = None) -> int | None:
        """The days of ``source`` after the dataset's mark, the
        mark's own day again (rows that came late to it are not lost) and the
        days re-opened, each replaced as a whole; the source holds whole days.
        Rows and the new mark are one version.  None if there is nothing to
        load.  The source is run through once: the new mark is the last day
        that has a folder."""
        if self.partition_col != date_col:
            raise ValueError("load_newer needs folders by the date column")
        mark = self.mark(dataset)
        days = F.lit(True) if mark is None else F.col(date_col) >= F.lit(mark)
        if mark is not None and reopened:
            days = days | F.col(date_col).isin(*reopened)

        def moved(written: list[str]) -> dict[str, dt.date] | None:
            loaded = [dt.date.fromisoformat(d) for d in (unquote(n.split("=", 1)[1]) for n in written) if d != NO_DATE]
            return {dataset: max([*loaded, mark] if mark else loaded)} if loaded else None
        return self.replace_partitions(source.where(days), moved)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete commits that none of the last ``keep`` versions names, those
        of lost jobs too.  Run it while no write is under way."""
        kept = set().union(*[self.manifest(v).commits() for v in self.versions()[-keep:]])
        gone = [n for n in self.files.names(f"{self.path}/data") if n.startswith("commit=") and n[7:] not in kept]
        for n in gone:
            self.files.delete(f"{self.path}/data/{n}")
        return gone

    def _like(self, df: DataFrame, base: Manifest | None) -> DataFrame:
        return df.select(*T.StructType.fromJson(json.loads(base.schema)).names) if base else df

    def _staged(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "version-incoming")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
