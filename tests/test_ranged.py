"""Sums, numbers and sweeps by ranges give what one window a group gives."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tesoro.operators import ranged
from tesoro.operators.positions import dense_sequence
from tesoro.operators.sweep import sweep_transfers


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark):
    rng = random.Random(9)
    rows = [("hot", i, rng.choice([0, 5, rng.randint(-400, 400)])) for i in range(3000)] + [(None, i, i) for i in range(200)] + [("few", 1, 7)]
    return spark.createDataFrame(rows, "g string, id long, v long").repartition(5)


def test_running_sums_and_numbers_by_ranges(spark):
    df = frame(spark)
    for lead, order in ((F.col("v"), ["v", "id"]), (-F.col("v"), [F.desc("v"), "id"])):
        plain = rows_of(ranged.running(df, ["g"], lead, order, {"before": "v"}, "nr"))
        for rows in (10, 500, 5000):
            assert rows_of(ranged.running(df, ["g"], lead, order, {"before": "v"}, "nr", rows=rows)) == plain
    want = rows_of(dense_sequence(df, ["g"], ["v", "id"], out_col="nr"))
    assert rows_of(dense_sequence(df.where("g IS NOT NULL"), ["g"], ["v", "id"], out_col="nr", rows=100)) == [r for r in want if r[0]]


def test_a_wide_group_is_many_ranges_of_like_size(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
    sizes = [r["count"] for r in ranged.with_slices(df, ["g"], F.col("v"), 1000).groupBy(ranged.SLICE).count().collect()]
    assert len(sizes) == ranged.RANGES and max(sizes) < 2 * 100_000 / ranged.RANGES
    assert ranged.has_wide_groups(df, ["g"], 99_999) and not ranged.has_wide_groups(df, ["g"], 100_000)


@pytest.mark.parametrize("mode", ["snapshot", "waterfall"])
def test_sweeps_by_ranges(spark, mode):
    rng = random.Random(3)
    day = dt.date(2026, 1, 1)
    rows = [(day, f"A{i:05d}", "EUR", Decimal(rng.choice([-100, 100, rng.randint(-9000, 9000)])) / 100) for i in range(900)]
    rows += [(day, f"B{i}", "GBP", Decimal(rng.randint(-900, 300)) / 100) for i in range(40)]
    rows += [(day, f"C{i}", "JPY", Decimal(5)) for i in range(60)] + [(day, "D", "USD", Decimal(-5)), (day, "E", "USD", Decimal(4))]
    b = spark.createDataFrame(rows, "date date, account_number string, currency string, closing_balance decimal(18,2)")
    plain = rows_of(sweep_transfers(b, mode=mode))
    assert len(plain) > 400
    for n in (50, 7):
        assert rows_of(sweep_transfers(b, mode=mode, range_rows=n)) == plain
