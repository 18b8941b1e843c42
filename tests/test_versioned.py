"""Versioned tables: what readers see when a write is lost, and that a retry
gives the rows of an undisturbed run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tesoro.session import scratch_path
from tesoro.sinks.versioned import ConcurrentCommit, VersionedTable
from tesoro.streaming.daily_files import daily_file_stream

D = [dt.date(2026, 1, i) for i in range(1, 9)]
SCHEMA = "date date, id string, amount double"


def frame(spark, rows):
    return spark.createDataFrame([(D[d], i, float(a)) for d, i, a in rows], SCHEMA)


def rows(df):
    return sorted((D.index(r.date), r.id, int(r.amount)) for r in df.select("date", "id", "amount").collect())


BASE = [(0, "a", 1), (1, "a", 2), (1, "b", 3), (2, "c", 4)]
NEW = [(1, "a", 20), (3, "d", 5)]
WRITES = {
    "replace_partitions": (lambda t, df: t.replace_partitions(df), [(0, "a", 1), (1, "a", 20), (2, "c", 4), (3, "d", 5)]),
    "upsert": (lambda t, df: t.upsert(df, ["date", "id"]), [(0, "a", 1), (1, "a", 20), (1, "b", 3), (2, "c", 4), (3, "d", 5)]),
    "overwrite": (lambda t, df: t.overwrite(df, ["date"]), NEW),
    "append": (lambda t, df: t.append(df), sorted(BASE + NEW)),
    "load_newer": (lambda t, df: t.load_newer(df, "x", "date"), [(0, "a", 1), (1, "a", 20), (2, "c", 4), (3, "d", 5)]),
}


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("name", WRITES)
def test_a_lost_write_is_not_seen_and_its_retry_is_whole(spark, monkeypatch, name, partitioned):
    write, want = WRITES[name]
    if not partitioned and name in ("replace_partitions", "load_newer"):
        return
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date" if partitioned else None)
    t.overwrite(frame(spark, BASE))
    before = t.read()

    def lost(self, manifest):
        raise RuntimeError("lost before the manifest")

    with monkeypatch.context() as m:        # rows are written, the manifest is not
        m.setattr(VersionedTable, "_publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            write(t, frame(spark, NEW))
    assert t.versions() == [1] and rows(t.read()) == BASE and t.mark("x") is None
    broken = frame(spark, NEW).withColumn("amount", F.when(F.col("id") == "d", F.raise_error(F.lit("lost task")).cast("double")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="lost task"):   # a task fails while rows are written
        write(t, broken)
    assert rows(t.read()) == BASE
    write(t, frame(spark, NEW))
    assert rows(t.read()) == want
    assert rows(before) == BASE == rows(t.read(1))      # readers of the old version go on
    assert len(t.vacuum(1)) >= 1 and rows(t.read()) == want


def test_the_second_of_two_writers_fails(spark):
    path = scratch_path(spark, "t-version")
    a, b = VersionedTable(spark, path, "date"), VersionedTable(spark, path, "date")
    a.overwrite(frame(spark, BASE))
    stale = b.manifest()
    a.append(frame(spark, NEW))
    b.manifest = lambda version=None: stale
    with pytest.raises(ConcurrentCommit):
        b.append(frame(spark, NEW))
    assert rows(a.read()) == sorted(BASE + NEW)
    assert [n for n in a.files.names(f"{path}/_versions") if n.startswith(".")] in ([], [f".{v:08d}.json.crc" for v in (1, 2)])


def test_upsert_has_one_row_a_key_and_nulls_are_equal(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-version"))
    first = spark.createDataFrame([(D[0], None, 1.0), (D[0], "a", 2.0), (D[0], "a", 3.0)], SCHEMA)
    t.upsert(first, ["date", "id"], recency=["amount"])
    for _ in range(2):
        t.upsert(spark.createDataFrame([(D[0], None, 9.0), (D[1], "b", 1.0)], SCHEMA), ["date", "id"])
    assert sorted((str(r.id), r.amount) for r in t.read().collect()) == [("None", 9.0), ("a", 3.0), ("b", 1.0)]


def test_filters_on_the_partition_column_prune(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    t.overwrite(frame(spark, BASE))
    t.replace_partitions(frame(spark, NEW))
    one = t.read().where(F.col("date") == D[1])
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    assert rows(one) == [(1, "a", 20)]
    t.overwrite(frame(spark, []))
    assert rows(t.read()) == [] and t.read().columns == ["date", "id", "amount"]


def test_marks_move_with_the_rows_and_late_rows_are_loaded(spark, monkeypatch):
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    source = BASE
    assert t.mark("fx") is None and t.load_newer(frame(spark, []), "fx", "date") is None
    t.load_newer(frame(spark, source), "fx", "date")
    assert t.mark("fx") == D[2] and t.mark("mtm") is None
    source = source + [(2, "late", 6), (4, "e", 7), (0, "correction", 8)]
    monkeypatch.setattr(VersionedTable, "_publish", lambda self, m: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.load_newer(frame(spark, source), "fx", "date")
    assert t.mark("fx") == D[2] and rows(t.read()) == BASE       # neither rows nor mark
    monkeypatch.undo()
    t.load_newer(frame(spark, source), "fx", "date")
    assert t.mark("fx") == D[4] and rows(t.read()) == sorted(source[:-1])
    t.load_newer(frame(spark, source), "fx", "date", reopened=[D[0]])
    assert rows(t.read()) == sorted(source) and t.mark("fx") == D[4]
    t.append(frame(spark, [(5, "f", 1)]), marks={"mtm": D[5]})
    assert (t.mark("fx"), t.mark("mtm")) == (D[4], D[5])


def test_a_load_runs_its_source_once(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    seen = spark.sparkContext.accumulator(0)

    def counted(d):
        seen.add(1)
        return d
    day = F.udf(counted, "date").asNondeterministic()
    source = frame(spark, [(0, "a", 1), (1, "a", 2), (1, "b", 3)]).withColumn("date", day("date"))
    t.load_newer(source, "fx", "date")
    assert seen.value == 3 and t.mark("fx") == D[1]
    undated = spark.createDataFrame([(None, "x", 1.0)], SCHEMA)
    new = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    assert new.load_newer(undated, "fx", "date") is None and new.versions() == []       # no day, nothing to load
    assert new.files.names(f"{new.path}/data") == []
    new.load_newer(undated.unionByName(frame(spark, BASE)), "fx", "date")
    assert new.mark("fx") == D[2] and new.read().count() == len(BASE) + 1


def test_days_of_a_week_are_dealt_together(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    p = t._dealt(frame(spark, BASE))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_week_of_date" in p
    t.replace_partitions(frame(spark, BASE))
    assert rows(t.read()) == BASE and len(t.manifest().parts) == len({r[0] for r in BASE})


def test_a_source_that_comes_again_loses_its_old_days(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-version"), "date")
    own = lambda r, source: frame(spark, r).withColumn("source", F.lit(source))
    t.replace_source(own([(0, "a", 1), (1, "a", 2)], "f1"), "source")
    t.replace_source(own([(1, "b", 3), (2, "b", 4)], "f2"), "source")
    for _ in range(2):
        t.replace_source(own([(1, "a", 20), (3, "a", 5)], "f1"), "source")
        assert rows(t.read()) == [(1, "a", 20), (1, "b", 3), (2, "b", 4), (3, "a", 5)]
    assert sorted(t.manifest().parts) == [f"date={D[i]}" for i in (1, 2, 3)]


def test_daily_files_into_a_versioned_table(spark, monkeypatch):
    landing, ckpt = scratch_path(spark, "t-landing"), scratch_path(spark, "t-ckpt")
    t = VersionedTable(spark, scratch_path(spark, "t-target"), "date")
    frame(spark, BASE).coalesce(1).write.option("header", True).csv(landing)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", lambda self, x: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            daily_file_stream(spark, landing, SCHEMA, t, ckpt)
    assert t.versions() == []
    daily_file_stream(spark, landing, SCHEMA, t, ckpt)      # the batch is replayed
    assert rows(t.read()) == BASE
    frame(spark, [(1, "late", 9)]).write.mode("append").option("header", True).csv(landing)
    for _ in range(2):
        daily_file_stream(spark, landing, SCHEMA, t, ckpt)
        assert rows(t.read()) == sorted(BASE + [(1, "late", 9)])
    keyed = VersionedTable(spark, scratch_path(spark, "t-target"), "period")
    daily_file_stream(spark, landing, SCHEMA, keyed, scratch_path(spark, "t-ckpt"), keys=["date", "id"], partition_col="period",
                      partition_expr=F.date_format("date", "yyyy-MM"))
    assert rows(keyed.read()) == sorted(BASE + [(1, "late", 9)])
