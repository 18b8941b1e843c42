import random

import numpy as np

from tesoro.llm import quality as qa
from tesoro.llm.common import table


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(7)
    n, k = 20000, len(qa.LABELLERS)
    good = rng.random(n) < 0.8
    rate = np.linspace(0.15, 0.45, k)
    v = np.where(~good[:, None] & (rng.random((n, k)) < rate), -1, 0)
    v[:, 6] = np.where(rng.random(n) < np.where(good, 0.9, 0.4), 1, 0)
    pats, counts = np.unique(v, axis=0, return_counts=True)
    model = qa.LabelModel([(tuple(int(x) for x in p), int(c)) for p, c in zip(pats, counts)])
    assert abs(model.share - 0.8) < 0.03
    others = [j for j in range(k) if j != 6]
    assert np.allclose(model.rate[0, others, 0], rate[others], atol=0.05)
    assert abs(model.rate[1, 6, 2] - 0.9) < 0.02 and abs(model.rate[0, 6, 2] - 0.4) < 0.06
    assert all(model.accuracies()[qa.LABELLERS[j]] > 0.95 for j in others)
    assert ((model.posterior(v) > 0.5) == good).mean() > 0.98


def test_agrees_with_held_labels(spark):
    d = "/root/testdata/sf0.1"
    docs = table(spark, d, "documents")
    got = {r["doc_id"]: r for r in qa.quality(docs).collect()}
    assert len(got) == docs.count()
    known = [(got[r["doc_id"]]["kept"], r["quality"]) for r in table(spark, d, "labels").collect()]
    good = [k for k, q in known if q == 1]
    bad = [k for k, q in known if q == 0]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.1


def test_odd_rows(spark, docs_of):
    rng = random.Random(1)
    prose = lambda n: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice("xyz") for _ in range(n)) + "."
    rows = [(i, prose(60) if i % 4 else "BUY!! NOW!! " * 20) for i in range(80)]
    rows += [(100, None), (101, ""), (None, prose(50)), (3, rows[3][1]), (102, prose(5) * 30000)]
    got = qa.quality(docs_of(rows)).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((d for d, _ in rows), key=str)
    by = {r.doc_id: r for r in got}
    assert by[None].kept and by[1].kept and not by[4].kept
    assert by[100].score == by[101].score
    assert all(len(r.votes) == len(qa.LABELLERS) and 0 <= r.score <= 1 for r in got)
    assert qa.quality(docs_of([])).collect() == []
