"""X01 / X04 / K02 / K04 / K05 / K07 / Z01 behaviour (FIXTURES.md §6 and the
rerun checks of §5.1)."""

import datetime as dt

from pyspark.sql import functions as F

from tesoro.operators import quality as Q
from tesoro.session import scratch_path
from tesoro.sinks import writers as K
from tesoro.sources import readers as S
from tesoro.streaming.daily_files import daily_file_stream

D = [dt.date(2026, 1, i) for i in range(1, 6)]
SCHEMA = "report_date date, value int"


def table(spark, n):
    return spark.createDataFrame([(D[i], 10 * (i + 1)) for i in range(n)], SCHEMA)


def test_incremental_append(spark):
    p = scratch_path(spark, "t-inc")
    missing = S.read_or_empty(spark, p, SCHEMA)
    assert Q.high_water_mark(missing, "report_date").first()[0] is None
    assert K.incremental_append(table(spark, 3), p, "report_date") is None
    mark = Q.high_water_mark(spark.read.parquet(p), "report_date").first()[0]
    assert mark == D[2]
    assert Q.incremental_slice(table(spark, 5), "report_date", mark).count() == 2
    assert K.incremental_append(table(spark, 5), p, "report_date") == mark
    K.incremental_append(table(spark, 5), p, "report_date")     # a repeated run adds nothing
    out = spark.read.parquet(p)
    assert out.count() == 5 and out.select("report_date").distinct().count() == 5


def test_replace_by_date_is_idempotent(spark):
    p = scratch_path(spark, "t-k04")
    df = table(spark, 5).withColumnRenamed("report_date", "date")
    K.replace_by_date(df, p)
    K.replace_by_date(df.filter(F.col("date") >= D[3]), p)
    K.replace_by_date(df.filter(F.col("date") >= D[3]), p)
    assert spark.read.parquet(p).count() == 5


def test_upsert_and_duplicate_deletes(spark):
    p = scratch_path(spark, "t-k05")
    base = spark.createDataFrame([(D[0], "EUR", 1.0), (D[1], "EUR", 1.1)], "date date, currency string, rate double")
    K.upsert_by_key(spark, p, base, ["date", "currency"], partition_col="date")
    inc = spark.createDataFrame([(D[1], "EUR", 2.1), (D[2], "EUR", 2.2)], "date date, currency string, rate double")
    K.upsert_by_key(spark, p, inc, ["date", "currency"], partition_col="date")
    got = {(r.date, r.rate) for r in spark.read.parquet(p).collect()}
    assert got == {(D[0], 1.0), (D[1], 2.1), (D[2], 2.2)}
    # in place without partitions; duplicates and NULL keys in the new rows
    q = scratch_path(spark, "t-k05-plain")
    K.upsert_by_key(spark, q, base, ["date", "currency"])
    more = spark.createDataFrame([(D[1], "EUR", 3.0), (D[1], "EUR", 4.0), (None, "EUR", 5.0)], base.schema)
    for _ in range(2):
        assert K.upsert_by_key(spark, q, more, ["date", "currency"], recency=["rate"]) == q
    assert {(r.date, r.rate) for r in spark.read.parquet(q).collect()} == {(D[0], 1.0), (D[1], 4.0), (None, 5.0)}
    assert spark.read.parquet(q).count() == 3
    dup = spark.createDataFrame([(D[0], "EUR", 1, 1.0), (D[0], "EUR", 2, 1.5), (D[1], "EUR", 1, 3.0)],
                                "date date, currency string, seq int, rate double")
    a = {tuple(r) for r in K.keep_last_per_key(dup, ["date", "currency"], ["seq"]).collect()}
    b = {tuple(r) for r in K.delete_duplicates_anti(dup, ["date", "currency"], "seq").collect()}
    assert a == b == {(D[0], "EUR", 2, 1.5), (D[1], "EUR", 1, 3.0)}
    assert K.duplicate_keys(dup, ["date", "currency"]).count() == 1


def test_daily_file_stream_rerun_safe(spark):
    landing = scratch_path(spark, "t-landing")
    target = scratch_path(spark, "t-target")
    ckpt = scratch_path(spark, "t-ckpt")
    df = spark.createDataFrame([(D[i], f"TX{i}", 1.0 * i) for i in range(5)], "date date, id string, amount double")
    df.write.option("header", True).csv(landing)
    schema = "date date, id string, amount double"
    daily_file_stream(spark, landing, schema, target, ckpt)
    daily_file_stream(spark, landing, schema, target, ckpt)
    assert spark.read.parquet(target).count() == 5
    df2 = spark.createDataFrame([(D[4], "TX9", 9.0)], schema)
    df2.write.mode("append").option("header", True).csv(landing)
    daily_file_stream(spark, landing, schema, target, ckpt)
    # the late file adds to its day; no row of the first batch is lost
    out = spark.read.parquet(target)
    assert sorted(r.id for r in out.collect()) == ["TX0", "TX1", "TX2", "TX3", "TX4", "TX9"]
    # all files loaded again (new checkpoint): the table stays as it is
    daily_file_stream(spark, landing, schema, target, scratch_path(spark, "t-ckpt2"))
    assert spark.read.parquet(target).count() == 6


def test_dated_scan_opens_only_the_last_days(spark):
    p = scratch_path(spark, "t-s03")
    df = table(spark, 5).withColumn("date", F.col("report_date"))
    K.per_day_partition_write(df, p, "date")
    out = S.dated_directory_scan(spark, p, SCHEMA, r"date=(\d{4}-\d{2}-\d{2})", last_n=2, reader="parquet")
    assert sorted(r.file_date for r in out.collect()) == D[3:]
    assert len(out.inputFiles()) == 2


def test_drifted_headers_and_quoted_cells(spark):
    p = scratch_path(spark, "t-s04")
    types = {"bank": "string", "account": "string", "note": "string"}
    spark.createDataFrame([("b1", "a1", "x, y"), ("b2", "a2", "bank,account,note,other")], "bank string, account string, note string") \
        .coalesce(1).write.option("header", True).csv(f"{p}/wide")
    spark.createDataFrame([("a3", "lower,case")], "account string, note string").coalesce(1).write.option("header", True).csv(f"{p}/narrow")
    dim = spark.createDataFrame([("a3", "b3")], "account string, bank string")
    out = S.drifted_schema_scan(spark, p, types, dimension=dim, key="account", backfill=["bank"])
    assert sorted(map(tuple, out.collect())) == [("b1", "a1", "x, y"), ("b2", "a2", "bank,account,note,other"), ("b3", "a3", "lower,case")]


def test_drifted_files_may_be_compressed_parts(spark, monkeypatch):
    p = scratch_path(spark, "t-s04-gz")
    monkeypatch.setattr(K, "CSV_PART_ROWS", 3)
    K.csv_parts(spark.range(10).selectExpr("concat('b', id) AS bank", "concat('a,', id) AS account").coalesce(1), f"{p}/wide")
    K.csv_parts(spark.range(10, 14).selectExpr("concat('a,', id) AS account").coalesce(1), f"{p}/narrow")
    K.csv_parts(spark.range(0).selectExpr("string(id) AS account"), f"{p}/none")
    assert "SortAggregate" not in S.header_prints(S.first_lines(spark, p))._jdf.queryExecution().executedPlan().toString()
    assert {h: len(f) for h, f in S.headers(spark, p).items()} == {"bank,account": 4, "account": 3}
    out = S.drifted_schema_scan(spark, p, {"bank": "string", "account": "string"})
    files = [f for f in out.inputFiles() if "/none/" not in f]
    assert len(files) == 6 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, out.fillna("").collect())) == sorted([(f"b{i}", f"a,{i}") for i in range(10)] + [("", f"a,{i}") for i in range(10, 14)])


def test_work_dir_needs_a_shared_folder_on_a_cluster(spark):
    import pytest

    from tesoro.session import work_dir

    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session())


def test_only_a_first_line_is_a_header(spark):
    import pytest
    p = scratch_path(spark, "t-s04-first")
    types = {"account": "string", "note": "string"}
    spark.createDataFrame([("account,note",), ("a1,x",), ("account,note",), ("a2,y",)], "value string").coalesce(1).write.text(f"{p}/one")
    out = S.drifted_schema_scan(spark, p, types)
    assert sorted(map(tuple, out.collect())) == [("a1", "x"), ("a2", "y"), ("account", "note")]
    spark.createDataFrame([("account,other",), ("a1,x",)], "value string").coalesce(1).write.text(f"{p}/two")
    with pytest.raises(ValueError, match="other"):
        S.drifted_schema_scan(spark, p, types)
