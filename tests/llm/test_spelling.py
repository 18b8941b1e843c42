import random
import re
import zlib
from collections import Counter

from tesoro.llm import spelling as sp
from tesoro.llm.common import table


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, slip):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    out = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        top = min(near, key=lambda x: (-n[x], x.encode()), default=None)
        out[w] = (top if top and n[top] >= 2 * n[w] else None, n[w], len(near))
    rows = []
    for w, (form, c, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, c, k, n[form] if form else None))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_random_words_equal_brute_force(spark):
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(2, 9))) for _ in range(500)} | {"a" * k for k in range(2, 30)}
    n = {w: rng.choice([3, 4, 6, 7, 13, 30, 70, 200, 900]) for w in words}
    counts = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    want = brute(n)
    assert sum(k for *_, k, _ in want) > 500 and sum(f is not None and f != r for _, f, r, *_ in want) > 20
    for tile in (sp.TILE, 3):
        assert got(sp.variants(counts, tile=tile)) == want


def test_long_ways_reach_the_root(spark):
    n = {"a" * k: 3 * 2 ** k for k in range(5, 26)}
    found = sp.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert {r.root for r in found} == {"a" * 25}


def test_texts_with_slips_equal_brute_force(spark, docs_of):
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdeéÿ×xyz", k=rng.randint(3, 12))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice([w, w.upper(), w.capitalize()]) + rng.choice([" ", ",", "\n", "1", "ǎ", "日"]) for w in rng.choices(base, k=60)))
            for i in range(150)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (200, None), (201, ""), (202, "Lettuce lettuce! " * 60_000), (-7, "a\x85bcdefg " * 4)]
    docs = docs_of(rows)
    for slip in (97, 5, 0):
        n = counted(rows, slip)
        assert dict(got(sp.word_counts(docs, slip).where("n >= 3"))) == n
        assert got(sp.spelling_variants(docs, slip)) == brute(n)
    assert got(sp.spelling_variants(docs_of([]), 97)) == []


def test_documents_equal_brute_force_counts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert dict(got(sp.word_counts(docs, 97).where("n >= 3"))) == counted([(r.doc_id, r.text) for r in docs.collect()], 97)


def test_normalised_words(spark, docs_of):
    docs = docs_of([(1, "lettuce " * 9 + "letuce"), (2, "Letuce! letuce"), (3, "tomato tomato tomato")])
    assert got(sp.normalised(docs)) == [(1, "letuce", "lettuce"), (2, "letuce", "lettuce")]
