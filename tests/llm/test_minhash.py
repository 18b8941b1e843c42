import random
import re

import numpy as np

from tesoro.llm import minhash as mh
from tesoro.llm.common import table


def sets_of(text, n):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(rows, n, percent):
    """(doc_id, n, component, kept) of rows with distinct ids."""
    sets = [(d, sets_of(t, n)) for d, t in rows]
    label = {d: d for d, _ in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    where = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, (d, s) in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            e, t = sets[j]
            c = len(s & t)
            if 100 * c >= percent * (len(s) + len(t) - c):
                a, b = sorted((root(d), root(e)))
                label[b] = a
    return sorted((d, len(s), root(d), root(d) == d) for d, s in sets)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def corpus(seed, groups=40, near=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 3)))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 5, 9, 12, 40, 150, 600]))]
        for _ in range(rng.randint(1, near)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 10])):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                w = w[:rng.randint(1, len(w))]
            rows.append(rng.choice([" ", "\n", " \t "]).join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(1)
    for j in (0.5, 0.8, 0.95):
        both = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64) * np.uint64(2)
        only = int(4000 * (1 - j) / j / 2)
        a, b = (np.unique(np.r_[both, rng.integers(0, 2 ** 63, only, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]) for _ in range(2))
        r = mh.registers([a, b])
        assert abs((r[0] == r[1]).mean() - j) < 0.15


def test_components_match_brute_force(spark, docs_of):
    for seed, n, percent in ((1, 3, 85), (2, 5, 80), (3, 3, 85)):
        rows = corpus(seed)
        assert got(mh.components(docs_of(rows), n, percent)) == brute(rows, n, percent)


def test_small_tiles_change_nothing(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mh, "TILE", 6)
    rows = corpus(5, groups=6, near=60)
    assert got(mh.components(docs_of(rows), 3, 85)) == brute(rows, 3, 85)


def test_driver_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(mh.components(docs, 3, 85)) == brute(rows, 3, 85)


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "x " * 20000), (None, "p q r s t"), (None, "P q r s t"), (7, "p q r s t"),
            (None, "only here now then there"), (None, "only here now then there"), (8, "same row twice over"), (8, "same row twice over")]
    out = mh.components(docs_of(rows)).collect()
    assert len(out) == len(rows)
    by = {(r.doc_id, r.n_shingles > 0): (r.component_id, r.kept) for r in out}
    assert by[1, False] == (1, True) and by[2, False] == (2, True) and by[5, True] == (4, False)
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] .count((7, False)) == 2
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None].count((None, True)) == 2
    kept = mh.keep_first(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 7, 8, None], key=str)
    assert mh.components(docs_of([])).collect() == []
    assert mh.keep_first(docs_of([])).collect() == []


def test_every_text_of_a_repeated_id_is_compared(docs_of, monkeypatch):
    rng = random.Random(13)
    rows, nears = [], []
    for i in range(0, 120, 3):
        one, two = (" ".join(f"g{i}w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(2))
        # one document near each text, so that both are in the cluster
        rows += [(i, one), (i, two), (i + 1, one + " more"), (i + 2, two + " more")]
        nears += [(i + 1, i), (i + 2, i)]
    for tile in (mh.TILE, 2):
        monkeypatch.setattr(mh, "TILE", tile)
        label = {r.doc_id: r.component_id for r in mh.components(docs_of(rows)).collect()}
        assert all(label[d] == c for d, c in nears)
