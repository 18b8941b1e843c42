"""Distinct counts from bitmaps against count_distinct over the facts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tesoro.operators import distinct as X

DAY = dt.date(2026, 3, 2)


def facts(spark, n=3000, ids=900, seed=1):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        hot = r.random() < 0.3      # one id, one day and one bank with a third of the rows
        rows.append((None if r.random() < 0.02 else "hot" if hot else f"id{r.randrange(ids)}",
                     None if r.random() < 0.02 else DAY if hot else DAY + dt.timedelta(days=r.randrange(40)),
                     None if r.random() < 0.05 else r.choice(["A", "A", "A", "B", "C"]), r.choice(["x", "y"])))
    return spark.createDataFrame(rows, "id string, day date, bank string, pair string").cache()


@pytest.mark.parametrize("rows", [5, 1_000_000])
def test_numbers_are_dense_and_follow_the_first_day(spark, rows):
    f = facts(spark)
    got = {r["id"]: r[X.NUMBER] for r in X.numbered_ids(f, "id", "day", rows=rows).collect()}
    first = {r["id"]: r["d"] for r in f.where("id IS NOT NULL").groupBy("id").agg(F.min("day").alias("d")).collect()}
    assert sorted(got.values()) == list(range(1, len(first) + 1)) and got.keys() == first.keys()
    days = [first[i] for i in sorted(got, key=got.get)]
    days = [d or dt.date.min for d in days]
    assert days == sorted(days)


def test_any_selection_equals_count_distinct(spark):
    f = facts(spark)
    numbers = X.numbered_ids(f, "id", "day")
    state = X._written(X.distinct_state(f, "id", ["day", "bank", "pair"], numbers), "t-state")
    r = random.Random(5)
    for _ in range(6):
        banks, pairs = r.sample(["A", "B", "C"], r.randint(1, 3)), r.sample(["x", "y"], r.randint(1, 2))
        lo = DAY + dt.timedelta(days=r.randrange(40))
        pick = F.col("bank").isin(banks) & F.col("pair").isin(pairs) & (F.col("day") >= F.lit(lo))
        by = r.sample(["day", "bank", "pair"], r.randint(0, 2))
        want = f.where(pick).groupBy(*by).agg(F.count_distinct("id").alias("n")).where("n > 0" if by else "true")
        assert sorted(map(str, X.distinct_counts(state.where(pick), by).collect())) == sorted(map(str, want.collect()))


def test_cube_tells_null_members_from_roll_ups(spark):
    f = facts(spark)
    state = X.distinct_state(f, "id", ["day", "bank", "pair"], X.numbered_ids(f, "id", "day"))
    want = f.cube("bank", "pair").agg(F.grouping_id().alias(X.LEVEL), F.count_distinct("id").alias("n"))
    cols = ["bank", "pair", X.LEVEL, "n"]
    assert sorted(map(str, X.distinct_cube(state, ["bank", "pair"]).select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_loads_merge_with_numbers_that_stay(spark):
    a, b = facts(spark, seed=1), facts(spark, ids=1500, seed=2)
    first = X._written(X.numbered_ids(a, "id", "day"), "t-numbers")
    both = X._written(X.numbered_ids(b, "id", "day", known=first), "t-numbers")
    assert both.count() == both.select("id").distinct().count() == both.agg(F.max(X.NUMBER)).first()[0]
    assert first.exceptAll(both).count() == 0
    members = ["bank"]
    state = X.merge_states(X.distinct_state(a, "id", members, first), X.distinct_state(b, "id", members, both))
    want = a.unionByName(b).groupBy("bank").agg(F.count_distinct("id").alias("n"))
    assert sorted(map(str, X.distinct_counts(state, members).collect())) == sorted(map(str, want.collect()))


def test_more_ids_than_one_bitmap(spark):
    f = spark.range(70_000).select(F.col("id"), F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("day"), (F.col("id") % 2).alias("side"))
    state = X.distinct_state(f.unionByName(f), "id", ["side"], X.numbered_ids(f, "id", "day"))
    assert [r.n for r in X.distinct_counts(state, ["side"]).orderBy("side").collect()] == [35_000, 35_000]
    assert X.distinct_counts(state, []).first().n == 70_000


def test_rolling_periods(spark):
    f = facts(spark).where("day IS NOT NULL")
    weeks = f.withColumn("week", F.date_trunc("week", "day").cast("date"))
    state = X.distinct_state(weeks, "id", ["week"], X.numbered_ids(weeks, "id", "day"))
    got = {r.week: r.n for r in X.distinct_rolling(state, "week", 7, 3).collect()}
    rows = [(r.week, r.id) for r in weeks.where("id IS NOT NULL").collect()]
    assert got == {w: len({i for v, i in rows if w - dt.timedelta(days=14) <= v <= w}) for w, _ in rows}


def test_no_rows(spark):
    f = facts(spark).limit(0)
    state = X.distinct_state(f, "id", ["bank"], X.numbered_ids(f, "id", "day"))
    assert X.distinct_counts(state, ["bank"]).collect() == [] and X.distinct_counts(state, []).first().n == 0
