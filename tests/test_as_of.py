"""As-of join on instants against a plain search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tesoro.operators.asof import as_of_join

T0 = dt.datetime(2026, 1, 1)
LEFT, RIGHT = "k string, t timestamp, id int, price double", "k string, t timestamp, price double, seq int"


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def brute_force(left, right, inclusive, tolerance):
    out = []
    for k, t, i, p in left:
        fits = [(u, seq, price) for rk, u, price, seq in right if None not in (k, t, rk, u) and rk == k
                and (u <= t if inclusive else u < t)]
        best = max(fits, default=None)
        if best and tolerance is not None and (t - best[0]).total_seconds() > tolerance:
            best = None
        out.append((k, t, i, p, best and best[2], best and best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows,kind", [(None, "timestamp"), (40, "timestamp"), (40, "timestamp_ntz")])
@pytest.mark.parametrize("inclusive,tolerance", [(True, None), (False, None), (True, 5)])
def test_equals_a_plain_search(spark, rows, kind, inclusive, tolerance):
    rng = random.Random(9)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(key(), at(rng.choice([None, *range(200)])), i, 1.0) for i in range(150)]
    left += left[:5]
    right = [(key(), at(rng.randrange(200)), float(j), rng.randrange(3) * 1000 + j) for j in range(120)] + [("hot", None, 1.0, 1), ("c", at(1), 1.0, 1)]
    frame = lambda data, ddl: spark.createDataFrame(data, ddl.replace("timestamp", kind))
    got = as_of_join(frame(left, LEFT), frame(right, RIGHT), ["k"], "t", "t",
                     {"seen": "price", "seq": "seq"}, tie=["seq"], inclusive=inclusive, tolerance=tolerance, rows=rows, ranges=4)
    assert got.columns == ["k", "t", "id", "price", "seen", "seq"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(left, right, inclusive, tolerance)


def test_a_hot_key_is_many_ranges(spark):
    n = 4000
    left = spark.range(n).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 10 + 5).alias("t"), "id")
    right = spark.range(n // 100).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 1000).alias("t"), F.col("id").alias("seq"))
    got = as_of_join(left, right, ["k"], "t", "t", {"seq": "seq"}, rows=100, ranges=16)
    assert got.where("seq = id div 100").count() == n
    assert "_slice" in got._jdf.queryExecution().optimizedPlan().toString()


def test_empty_sides(spark):
    none_l, none_r = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    one = spark.createDataFrame([("a", at(1), 1, 1.0)], LEFT)
    assert as_of_join(none_l, none_r, ["k"], "t", "t", {"seq": "seq"}).collect() == []
    assert as_of_join(one, none_r, ["k"], "t", "t", {"seq": "seq"}, rows=10).first()["seq"] is None
