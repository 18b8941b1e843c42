"""
operators that split hot groups."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tesoro.operators import intervals as I
from tesoro.operators.ledger import ledger_roll_forward
from tesoro.operators.positions import dense_sequence
from tesoro.session import scratch_path
from tesoro.sinks import writers as K
from tesoro.sources import readers as S

DAYS = [dt.date(2026, 3, d) for d in range(1, 8)]


def rows(spark):
    return spark.createDataFrame([(d, f"A{i}", float(i)) for i, d in enumerate(DAYS)],
                                 "date date, account_number string, amount double")


def test_csv_overwrite_rerun(spark):
    p = scratch_path(spark, "t-k01")
    for _ in range(2):
        K.csv_overwrite(rows(spark), p)
    assert S.csv_scan(spark, p, "date date, account_number string, amount double").count() == 7


def test_per_day_partition_write_and_prune(spark):
    p = scratch_path(spark, "t-k03")
    K.per_day_partition_write(rows(spark), p, "date", mode="overwrite")
    K.per_day_partition_write(rows(spark), p, "date", mode="overwrite")
    df = spark.read.parquet(p)
    assert df.count() == 7
    one = df.filter(F.col("date") == DAYS[3])
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_create_add_insert_export(spark):
    p = scratch_path(spark, "t-k09")
    K.create_table_if_absent(spark, p, "date date, account_number string, amount double")
    rows(spark).write.mode("append").parquet(p)
    assert K.create_table_if_absent(spark, p, "date date, account_number string, amount double").count() == 7
    old = spark.read.parquet(p)
    assert {r.flag for r in K.add_column_with_default(old, "flag", "raw").collect()} == {"raw"}
    cand = rows(spark).unionByName(spark.createDataFrame([(dt.date(2026, 3, 9), "A9", 9.0)], old.schema))
    missing = K.insert_missing_rows(old, cand, ["date", "account_number"])
    assert [r.account_number for r in missing.collect()] == ["A9"]
    q = scratch_path(spark, "t-k12")
    K.ordered_export(cand, q, ["date"])
    K.ordered_export(cand, q, ["date"])
    assert spark.read.parquet(q).count() == 8


def test_hot_bank_delta_equals_expansion(spark):
    # one bank holds almost every leg; one day holds a burst of trades
    legs = [("hot", i, dt.date(2026, 1, 1 + i % 20), dt.date(2026, 1, 3 + i % 20 + i % 5), Decimal(i % 97 + 1))
            for i in range(3000)] + [("cold", 1, dt.date(2026, 1, 2), dt.date(2026, 1, 9), Decimal("5.00"))]
    df = spark.createDataFrame(legs, "bank_id string, trade_id int, trade_date date, value_date date, size decimal(18,2)")
    bd = spark.createDataFrame([(dt.date(2026, 1, d),) for d in range(1, 31) if dt.date(2026, 1, d).weekday() < 5],
                               "report_date date")
    exp = (I.expand_active(df, bd, "trade_date", "value_date").groupBy("bank_id", "report_date")
           .agg(F.sum("size").alias("e"), F.count(F.lit(1)).alias("n")))
    a = {(r.bank_id, r.report_date): (r.e, r.n) for r in exp.collect()}
    b = {(r.bank_id, r.report_date): (r.exposure, r.active_legs)
         for r in I.exposure_series(df, bd, ["bank_id"], "trade_date", "value_date", "size").collect()}
    assert a == b


def test_sliced_numbering_on_a_giant_group(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id"))
    plain = sorted((r.id, r.seq) for r in dense_sequence(df, ["g"], ["id"], out_col="seq").collect())
    for step in (5000, 625, 79):
        assert sorted((r.id, r.seq) for r in dense_sequence(df, ["g"], ["id"], step, "seq").collect()) == plain
