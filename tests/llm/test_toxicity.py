import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tesoro.llm import toxicity as tox
from tesoro.llm.common import table


def weighted(counts, own, held, total, rare, telling):
    """Unit vector of a text as a dict, by the definition alone."""
    x = {}
    for t, n in counts.items():
        idf = math.log1p(total / max(held.get(t, 0), total / rare))
        x[t] = (1 + math.log(n)) * idf * (telling.get(t, 1.0) if t in own else 1.0)
    norm = math.sqrt(sum(v * v for v in x.values()))
    return {t: v / norm for t, v in x.items()}


@pytest.mark.parametrize("dense", [4, 14, 1000])
def test_index_is_exact(monkeypatch, dense):
    monkeypatch.setattr(tox, "DENSE", dense)
    rng = np.random.default_rng(1)
    terms = [b"t%d" % i for i in range(60)]
    held = {t: i + 1 for i, t in enumerate(terms[:50])}
    make = lambda n: [{terms[j]: int(rng.integers(1, 4)) for j in rng.choice(60, rng.integers(0, 9), replace=False)} for _ in range(n)]
    counts, labels = make(300), [int(x) for x in rng.integers(0, 2, 300)]
    index = tox.Examples(counts, labels, list(range(300)), held, 400, {0: 900, 1: 100}, k=7, rare=200)
    own = set().union(*counts)
    telling = {t: float(index.telling[index.column[t]]) for t in own}
    full = {i: weighted(c, own, held, 400, 200, telling) for i, c in enumerate(counts) if c}
    for c in make(60) + counts[:20] + [{b"new": 3}, {b"new": 1, terms[0]: 2}]:
        q = weighted(c, own, held, 400, 200, telling) if c else {}
        (sims,), (rows,) = index.nearest([index.vector(c)])
        cosine = {i: sum(w * full[i].get(t, 0) for t, w in q.items()) for i in full}
        want = sorted((s for s in cosine.values() if s > 1e-9), reverse=True)[:7]
        assert np.allclose(sims, want + [0] * (7 - len(want)), atol=2e-9)
        for s, r in zip(sims, rows):
            assert r < 0 or math.isclose(cosine[int(index.ids[r])], s, abs_tol=2e-9)


def brute_force(rows, label_of, k=tox.NEIGHBOURS, rare=tox.RARE):
    """Score of every row (one text an id, every id labelled or held out):
    all cosines, votes and calibration written plainly."""
    words = [Counter(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())) for _, t in rows]
    total, df = len(rows), Counter()
    for w in words:
        df.update(w.keys())
    known = [i for i, (d, _) in enumerate(rows) if d in label_of and zlib.crc32(str(d).encode()) % 5]
    n = Counter(label_of[rows[i][0]] for i in known)
    own = set().union(*(words[i] for i in known))
    telling = {}
    for t in own:
        a, b = (sum(1 for i in known if label_of[rows[i][0]] == c and t in words[i]) for c in (0, 1))
        share, g2 = (a + b) / len(known), 0.0
        for o, e in ((a, n[0] * share), (b, n[1] * share), (n[0] - a, n[0] * (1 - share)), (n[1] - b, n[1] * (1 - share))):
            g2 += 2 * o * math.log(o / e) if o else 0
        telling[t] = 1 + tox.LABEL_WEIGHT * max(0, math.sqrt(max(g2, 0)) - tox.CHANCE)
    unit = [weighted(w, own, df, total, rare, telling) if w else {} for w in words]

    def vote(i, skip=None):
        near = sorted(((round(sum(w * unit[j].get(t, 0) for t, w in unit[i].items()), 9), j) for j in known if j != skip), reverse=True)[:k]
        near = [(s, j) for s, j in near if s > 0]
        w = [(1 / (0.05 + math.sqrt(max(0, 2 - 2 * s))), label_of[rows[j][0]]) for s, j in near]
        return sum(x * y for x, y in w) / sum(x for x, _ in w) if w else None

    # weighted logistic fit; classes weigh 1 a row here as every example is used
    points = [(vote(i, i), label_of[rows[i][0]]) for i in known]
    points = [(v, y) for v, y in points if v is not None]
    x, y = np.array([[v, 1] for v, _ in points]), np.array([0.98 * y + 0.01 for _, y in points])
    beta = np.array([6.0, -3.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (p - y) + 0.05 * (beta - [6.0, -3.0])
        beta = beta - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2), grad)
    assert all(unit[i] for i in known)     # so a text without known words counts as clean
    votes = [vote(i) for i in range(len(rows))]
    return [0.0 if v is None else 1 / (1 + math.exp(-(beta[0] * v + beta[1]))) for v in votes]


def test_scores_equal_brute_force(spark, docs_of):
    rng = random.Random(7)
    common, rest = [f"w{i}" for i in range(30)], [f"x{i}" for i in range(3000)]
    rows = []
    for i in range(260):
        text = [rng.choice(common) for _ in range(rng.randint(5, 30))] + [rng.choice(rest) for _ in range(rng.randint(2, 12))]
        rows.append((i, " ".join(text + (["Foul", "nasty"][:1 + i % 2] if i % 4 == 0 else []))))
    rows += [(500, "zz1 zz2 zz3"), (501, None), (502, "")]
    label_of = {i: int(i % 4 == 0) for i in range(260)}
    labels = spark.createDataFrame([(i, 1, t, "x") for i, t in label_of.items()], "doc_id long, quality int, toxic int, text string")
    want = brute_force(rows, label_of, rare=tox.RARE)
    got = {r["doc_id"]: r for r in tox.toxicity(docs_of(rows), labels).collect()}
    assert len(got) == len(rows)
    far = [i for (i, _), s in zip(rows, want) if abs(got[i]["score"] - s) > 1e-6]
    assert not far, far
    assert got[500]["evidence"] == [] and got[501]["score"] == got[502]["score"] == got[500]["score"]
    assert "foul" in got[0]["terms"] and got[0]["evidence"]


def test_frequencies_of_all_words(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tox, "FLUSH", 3)
    rows = [(1, "a b c d e f a"), (2, "a A b"), (2, "a"), (None, None), (3, "")]
    got = {bytes(r["term"]).decode(): r["n"] for r in tox.document_frequencies(docs_of(rows)).collect()}
    assert got == {"": 5, "a": 3, "b": 2, "c": 1, "d": 1, "e": 1, "f": 1}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    got = {r["doc_id"]: r for r in tox.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert sum(not r["evidence"] for r in got.values()) <= 0.05 * len(got)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if got[r["doc_id"]]["held_out"]}
    hits = [(got[i]["predicted"], t) for i, t in known.items()]
    assert sum(p for p, t in hits if t) >= 0.9 * sum(t for _, t in hits)
    assert sum(p for p, t in hits if not t) <= 0.005 * len(hits)


def test_odd_rows(spark, docs_of):
    rng = random.Random(3)
    word = lambda: rng.choice(["sun", "moon", "tree", "river"])
    rows = [(i, " ".join([word() for _ in range(20)] + (["vile"] if i % 2 else []))) for i in range(200)]
    rows += [(900, None), (901, ""), (None, "vile sun"), (3, rows[3][1]), (902, "vile " * 30000)]
    labels = spark.createDataFrame([(i, 1, i % 2, "x") for i in range(200)] + [(5, 1, 1, "x"), (7, 1, None, "x"), (None, 0, 1, "x"), (9999, 0, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = tox.toxicity(docs_of(rows), labels).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["predicted"] == 1 and by[None]["held_out"] is False and by[902]["predicted"] == 1
    assert by[900]["score"] == by[901]["score"] < 0.5
    assert [by[i]["predicted"] for i in range(200)] == [i % 2 for i in range(200)]
    kept = tox.keep_civil(docs_of(rows), tox.fit(docs_of(rows), labels))
    assert kept.columns == docs_of([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i in range(0, 200, 2)] + [900, 901])
    none = labels.where("false")
    assert {r["score"] for r in tox.toxicity(docs_of(rows), none).collect()} == {0.0}
    assert tox.toxicity(docs_of([]), labels).collect() == []
