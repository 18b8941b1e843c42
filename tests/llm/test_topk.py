import math

import numpy as np

from pyspark.sql import functions as F
from tesoro.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


LONG = 2 ** 63 - 1


def held(x):
    return min(max(x, -LONG - 1), LONG)


def brute(rows, k=5, every=2):
    own = {(i, tuple(held(math.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, qv in own:
        if q % every == 0:
            hits = sorted((-held(sum(a * b for a, b in zip(qv, v))), i) for i, v in own if i != q and len(v) == len(qv))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])}
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], SCHEMA)
    got = topk.exact_top_k(topk.integer_vectors(df), F.pmod("vec_id", F.lit(2)) == 0, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_random_ties_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(300)]
    rows += [(i + 1000, rows[i][1]) for i in range(40)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, query_block=50) == brute(rows)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
            (7, [0.5, -0.25]), (None, [1.0, 1.0]), (8, [1.0]), (9, [3e7, -2e7]), (10, [1e30, 1.0]), (11, [])]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, []) == []
