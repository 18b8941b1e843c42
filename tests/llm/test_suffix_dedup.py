import hashlib
import random

import numpy as np

from tesoro.llm import suffix_dedup as sd
from tesoro.llm.common import table


def brute(rows, length=100):
    """(doc_id, text) of distinct ids (None last) -> results per document."""
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[d, t] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *out[d, t]) for d, t in rows), key=str)


def got(df):
    rows = df.collect()
    for r in rows:
        if r.kept is not None:
            assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


def corpus(seed, docs=60, alphabet="abcdé "):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [make(rng.choice([40, 99, 100, 101, 130, 300])) for _ in range(8)]
    rows = []
    for i in range(docs):
        t = make(rng.choice([0, 50, 99, 100, 400]))
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            if rng.random() < 0.4:
                k = rng.randrange(len(s))
                s = s[:k] + rng.choice(alphabet) + s[k + 1:]
            if rng.random() < 0.3:
                s = s[rng.randrange(len(s)):]
            at = rng.randint(0, len(t))
            t = t[:at] + s + t[at:]
        rows.append((i, t))
    return rows


def test_suffix_sort_orders_and_verifies():
    rng = random.Random(3)
    strings, group = [], []
    for g in range(40):
        base = "".join(rng.choice("ab") for _ in range(30)).encode()
        for _ in range(rng.randint(1, 17)):
            strings.append(base[: rng.randint(0, 30)] + "".join(rng.choice("ab") for _ in range(rng.randint(0, 4))).encode())
            group.append(g)
    sorter = sd.SuffixSort(strings, np.array(group))

    def check(order, common):
        for i, x in enumerate(order):
            assert group[x] == group[i]
            if common[i] < 0:
                assert i == 0 or group[order[i - 1]] != group[x]
                continue
            a, b = strings[order[i - 1]], strings[x]
            assert a <= b
            assert common[i] == next((k for k, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))

    check(*sorter.sorted())
    # hashes that always collide are found out on the bytes
    sorter.hash.part = lambda a, b: np.zeros(len(a), np.uint64)
    check(*sorter.sorted())


def test_matches_brute_force(spark, docs_of):
    for seed in (1, 2, 3):
        rows = corpus(seed)
        assert got(sd.suffix_dedup(docs_of(rows))) == brute(rows)


def test_hot_groups_pieces_and_small_grams(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    line = "".join(rng.choice("abcdefgh ") for _ in range(70))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(40))
    rows = [(i, word() + line + word() + (word() * 3 if i % 7 == 0 else "")) for i in range(120)] + corpus(11)[60 - 20:]
    rows += [(500 + i, rows[3][1] + "tail" * i) for i in range(5)]
    want = brute(rows)
    assert got(sd.suffix_dedup(docs_of(rows))) == want
    monkeypatch.setattr(sd, "PIECE", 150)
    assert sd.hot_grams(sd.keyed(docs_of(rows))[0])
    assert got(sd.suffix_dedup(docs_of(rows))) == want
    assert got(sd.suffix_dedup(docs_of(rows), gram=12)) == want


def test_odd_rows(spark, docs_of):
    rng = random.Random(4)
    long = "".join(rng.choice("xyz") for _ in range(5000))
    rows = [(1, None), (2, ""), (3, "a" * 1000), (4, "ab" * 400), (5, long), (6, long + "z" + long), (7, "é" * 300), (8, "a" * 99), (9, "a" * 101)]
    assert got(sd.suffix_dedup(docs_of(rows))) == brute(rows)
    # repeated rows are one document; null ids come last
    rows += [(5, long), (None, long[10:300])]
    assert got(sd.suffix_dedup(docs_of(rows))) == brute(rows)
    assert sd.suffix_dedup(docs_of([])).collect() == []


def test_driver_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(sd.suffix_dedup(docs)) == brute(rows)
