"""Keyed tables whose upserts read and write few files.

A :class:`KeyedTable` is a versioned table in parts of about ``part_rows`` rows,
each a range of keys of the load that wrote it.  Beside its rows every commit
keeps, for each of its parts, the smallest and largest key and a Bloom filter
of the keys (bitmaps of 32,768 bits, ``HASHES`` bits a key of ``BITS_A_KEY``).
An upsert looks its keys up there; only parts that may hold one are read and
written anew, the others stay as they are in the next manifest.

Filters are written before the manifest that names their commit, so a version
never lacks them, and a lost job leaves files that no manifest names.  A part
passes wrongly for about one key in 20,000, which costs its reading and changes
no row.  The look-up joins keys and bitmaps by bucket: its work grows with
keys x parts, and beyond ``LOOKUP_KEYS`` keys every part counts as touched, as
so many keys stand in most parts anyway.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesoro.sinks.versioned import Manifest, VersionedTable
from tesoro.sinks.writers import keep_last_per_key

PART = "_part"
PART_ROWS = 1_000_000
BITS_A_KEY = 24
HASHES = 8
BITMAP = 32_768
LOOKUP_KEYS = 100_000


class KeyedTable(VersionedTable):
    """A table of one row a key at ``path``; NULL equals NULL in keys."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], part_rows: int = PART_ROWS):
        super().__init__(spark, path, PART)
        self.keys, self.part_rows = keys, part_rows
        self.bits = BITMAP * math.ceil(part_rows * BITS_A_KEY / BITMAP)

    def read(self, version: int | None = None) -> DataFrame:
        return super().read(version).drop(PART)

    def parts(self) -> list[str]:
        m = self.manifest()
        return sorted(p.split("=", 1)[1] for p in m.parts) if m else []

    # --- filters ---------------------------------------------------------------

    def _key(self) -> Column:
        return F.struct(*[F.col(k) for k in self.keys])

    def _places(self, df: DataFrame, *columns: str) -> DataFrame:
        """``columns`` and, for each hash of a row's key, its bitmap and bit."""
        places = F.array(*[F.pmod(F.xxhash64(*self.keys, F.lit(j)), F.lit(self.bits)) + 1 for j in range(HASHES)])
        return df.select(*columns, F.explode(F.array_distinct(places)).alias("_place")).select(
            *columns, F.bitmap_bucket_number("_place").alias("bucket"), F.bitmap_bit_position("_place").alias("bit"))

    def _publish(self, m: Manifest) -> None:
        have = set(self.files.names(f"{self.path}/filters"))
        schema = T.StructType.fromJson(json.loads(m.schema))
        for c in sorted(m.commits()):
            if f"commit={c}" not in have:
                rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data/commit={c}").parquet(f"{self.path}/data/commit={c}")
                ranges = rows.groupBy(PART).agg(F.min(self._key()).alias("lo"), F.max(self._key()).alias("hi"))
                bits = self._places(rows, PART).groupBy(PART, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
                bits.join(ranges, PART).write.parquet(f"{self.path}/filters/commit={c}")
        super()._publish(m)

    def touched(self, incoming: DataFrame) -> list[str]:
        """The parts that may hold a key of ``incoming``."""
        m = self.manifest()
        live = self.parts()
        if not live:
            return []
        keys = incoming.select(*self.keys).distinct()
        if len(keys.take(LOOKUP_KEYS + 1)) > LOOKUP_KEYS:
            return live
        filters = self.spark.read.parquet(*[f"{self.path}/filters/commit={c}" for c in sorted(m.commits())])
        filters = filters.join(self.spark.createDataFrame([(p,) for p in live], f"{PART} string"), PART)
        asked = self._places(keys.withColumn("_key", self._key()).withColumn("_asked", F.size(F.array_distinct(F.array(
            *[F.pmod(F.xxhash64(*self.keys, F.lit(j)), F.lit(self.bits)) for j in range(HASHES)])))), "_key", "_asked")
        is_set = F.expr("shiftright(cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int), cast(bit % 8 as int)) % 2 = 1")
        hits = (asked.join(filters, "bucket").where((F.col("lo") <= F.col("_key")) & (F.col("_key") <= F.col("hi"))).where(is_set)
                .groupBy("_key", "_asked", PART).agg(F.count(F.lit(1)).alias("_n")).where("_n = _asked"))
        return sorted(r[0] for r in hits.select(PART).distinct().collect())   # at most the parts of the manifest

    # --- writing ---------------------------------------------------------------

    def _parted(self, df: DataFrame) -> DataFrame:
        """``df``, a written table, by ranges of keys in parts of new names."""
        n = max(1, math.ceil(df.count() / self.part_rows))
        number = F.lpad(F.spark_partition_id().cast("string"), 6, "0")
        return df.repartitionByRange(n, *self.keys).withColumn(PART, F.concat(F.lit(f"p{uuid.uuid4().hex[:12]}-"), number))

    def _plain(self, df: DataFrame, base: Manifest | None) -> DataFrame:
        return df.select(*[c for c in T.StructType.fromJson(json.loads(base.schema)).names if c != PART]) if base else df

    def _replace(self, rows: DataFrame, base: Manifest | None, gone: list[str]) -> int:
        out = {f"{PART}={p}" for p in gone}
        return self._commit(self._parted(self._staged(rows)), base, lambda part, written: part not in out)

    def _of(self, base: Manifest, parts: list[str]) -> DataFrame:
        own = {f"{PART}={p}" for p in parts}
        return self._rows(Manifest(base.version, base.schema, {p: c for p, c in base.parts.items() if p in own})).drop(PART)

    def overwrite(self, df: DataFrame, order: list[str] | None = None) -> int:
        return self._replace(keep_last_per_key(df, self.keys, order or []), self.manifest(), self.parts())

    def upsert(self, incoming: DataFrame, recency: list[str] | None = None) -> int:
        """The last row of a key, by ``recency``, replaces the row of the
        same key; new keys are added."""
        base = self.manifest()
        fresh = keep_last_per_key(self._plain(incoming, base), self.keys, recency or [])
        if base is None:
            return self._replace(fresh, base, [])
        fresh = self._staged(fresh)
        parts = self.touched(fresh)
        old = self._of(base, parts)
        stay = old.join(fresh.select(*self.keys), [old[k].eqNullSafe(fresh[k]) for k in self.keys], "left_anti")
        return self._replace(stay.select(*fresh.columns).unionByName(fresh), base, parts)

    def insert_missing(self, incoming: DataFrame, recency: list[str] | None = None) -> int:
        """Rows whose key the table does not hold; no part is rewritten."""
        base = self.manifest()
        fresh = keep_last_per_key(self._plain(incoming, base), self.keys, recency or [])
        if base is None:
            return self._replace(fresh, base, [])
        fresh = self._staged(fresh)
        old = self._of(base, self.touched(fresh)).select(*self.keys)
        return self._replace(fresh.join(old, [fresh[k].eqNullSafe(old[k]) for k in self.keys], "left_anti"), base, [])

    def vacuum(self, keep: int = 2) -> list[str]:
        gone = super().vacuum(keep)
        for n in gone:
            self.files.delete(f"{self.path}/filters/{n}")
        return gone
