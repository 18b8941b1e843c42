"""Keyed tables: rows as by a plain upsert, few parts read and written."""

import pytest
from pyspark.sql import functions as F

from tesoro.session import scratch_path
from tesoro.sinks.keyed import KeyedTable

SCHEMA = "id long, code string, amount double"


def rows(df):
    return sorted(((r.id, r.code, r.amount) for r in df.collect()), key=str)


def table(spark, **more):
    return KeyedTable(spark, scratch_path(spark, "t-keyed"), ["id", "code"], **more)


def test_ten_keys_touch_few_of_many_parts(spark):
    t = table(spark, part_rows=50)
    # two loads whose key ranges overlap: only the filters tell their parts apart
    base = spark.range(5000).select((F.col("id") * 7919 % 100_003).alias("id"), F.lit("a").alias("code"), F.lit(1.0).alias("amount"))
    t.upsert(base.where("id % 2 = 0"))
    t.upsert(base.where("id % 2 = 1"))
    parts = t.parts()
    assert len(parts) >= 100
    held = [r.id for r in base.orderBy("id").collect()][::500]
    new = spark.createDataFrame([(i, "a", 2.0) for i in held] + [(-5, "a", 3.0), (held[0], None, 4.0)], SCHEMA)
    touched = t.touched(new)
    assert 1 <= len(touched) <= len(held) + 1
    before = set(parts)
    t.upsert(new)
    assert before - set(t.parts()) == set(touched)      # the others stay as they are
    want = {(r.id, r.code): r.amount for r in base.collect()} | {(i, "a"): 2.0 for i in held} | {(-5, "a"): 3.0, (held[0], None): 4.0}
    assert rows(t.read()) == sorted(((i, c, a) for (i, c), a in want.items()), key=str)


def test_null_keys_repeated_rows_and_missing_rows(spark):
    t = table(spark, part_rows=2)
    t.upsert(spark.createDataFrame([(1, "a", 1.0), (None, "a", 2.0), (1, None, 3.0), (2, "b", 4.0), (2, "b", 5.0)], SCHEMA), ["amount"])
    t.upsert(spark.createDataFrame([(None, "a", 20.0), (1, None, 30.0), (1, None, 31.0), (None, None, 6.0)], SCHEMA), ["amount"])
    want = [(1, "a", 1.0), (None, "a", 20.0), (1, None, 31.0), (2, "b", 5.0), (None, None, 6.0)]
    assert rows(t.read()) == sorted(want, key=str)
    kept = t.parts()
    t.insert_missing(spark.createDataFrame([(None, None, 7.0), (3, "c", 8.0)], SCHEMA))
    assert rows(t.read()) == sorted([*want, (3, "c", 8.0)], key=str) and set(kept) <= set(t.parts())
    t.upsert(spark.createDataFrame([], SCHEMA))
    assert len(rows(t.read())) == 6


def test_more_keys_than_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr("tesoro.sinks.keyed.LOOKUP_KEYS", 3)
    t = table(spark, part_rows=5)
    base = spark.range(30).select("id", F.lit("a").alias("code"), F.lit(1.0).alias("amount"))
    t.upsert(base)
    assert t.touched(base) == t.parts()
    t.upsert(base.where("id < 10").withColumn("amount", F.lit(2.0)))
    assert rows(t.read()) == sorted(((i, "a", 2.0 if i < 10 else 1.0) for i in range(30)), key=str)


def test_a_lost_upsert_is_not_seen_and_its_retry_is_whole(spark, monkeypatch):
    t = table(spark, part_rows=5)
    base = spark.range(20).select("id", F.lit("a").alias("code"), F.lit(1.0).alias("amount"))
    t.overwrite(base)
    new = spark.createDataFrame([(3, "a", 9.0), (50, "a", 9.0)], SCHEMA)

    def lost(self, file, text):
        raise RuntimeError("lost before the manifest")

    with monkeypatch.context() as m:        # rows and filters are written, the manifest is not
        m.setattr("tesoro.sinks.versioned._Files.put_new", lost)
        with pytest.raises(RuntimeError, match="lost"):
            t.upsert(new)
    assert t.versions() == [1] and rows(t.read()) == rows(base)
    t.upsert(new)
    want = rows(base.where("id <> 3").unionByName(new))
    assert rows(t.read()) == want and len(t.vacuum(1)) == 1
    assert rows(t.read()) == want and t.touched(new)
