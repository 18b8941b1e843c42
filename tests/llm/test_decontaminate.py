import random

from tesoro.llm import decontaminate as dec


def distance(item, text):
    """Fewest edits of item against any substring of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def noisy(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        i = rng.randrange(len(t))
        what = rng.randrange(3)
        t[i:i + 1] = [rng.choice("abcxyz")] if what == 0 else [] if what == 1 else [t[i], rng.choice("abcxyz")]
    return "".join(t)


def cases():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.choice([6, 20, 40]))) for i in range(8)] + [(20, "tiny"), (21, None), (22, ""), (23, "a b, c"), (24, "...")]
    docs = []
    for i in range(50):
        t = prose(rng.choice([0, 30, 200]))
        if i % 2:
            item = rng.choice(items[:8])[1]
            cut = rng.randrange(len(t) + 1)
            t = t[:cut] + " " + noisy(rng, item, rng.randint(0, len(item) // 12)) + " " + t[cut:]
        docs.append((i, t))
    docs += [(60, None), (61, ""), (None, "xx " + items[1][1].upper().replace(" ", ",\n") + "!"), (62, items[2][1] * 3), (1, docs[1][1]),
             (63, "xtiny tinyx a b"), (64, "x a b a B C."), (65, "Tiny; a b c tiny")]
    return docs, items


def test_matches_brute_force(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = dec.contaminated(docs_of(docs), bench).collect()
    found = sorted(((r.doc_id, r.item_id, r.edits) for r in got), key=str)
    want = []
    for d, t in docs:
        text = dec.reduced(t).decode()
        for i, item in items:
            p = dec.reduced(item).decode()
            if len(p) >= dec.Q and (n := distance(p, text)) <= dec.budget(len(p)):
                want.append((d, i, n))
            if 0 < len(p) < dec.Q and f" {p} " in f" {text} ":
                want.append((d, i, 0))
    assert found == sorted(want, key=str)
    assert any(n == 0 for *_, n in want) and any(n > 1 for *_, n in want)
    flagged = [d for d, *_ in want]
    kept = dec.keep_clean(docs_of(docs), bench)
    assert kept.columns == docs_of([]).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in flagged), key=str)


def test_blocks_of_items_and_empty_tables(spark, docs_of, monkeypatch):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, dec.contaminated(docs_of(docs), bench).collect()))
    monkeypatch.setattr(dec.item_blocks, "__defaults__", (300,))
    assert sorted(map(str, dec.contaminated(docs_of(docs), bench).collect())) == one
    assert dec.contaminated(docs_of([]), bench).collect() == []
    assert dec.contaminated(docs_of(docs), bench.where("false")).collect() == []


def test_band_of_many_diagonals():
    rng = random.Random(12)
    chars = lambda n: bytes(rng.choice(b"abcdefghij") for _ in range(n))
    item, head = chars(300), chars(6000)
    text = head + item[:100] + item[101:200] + b"z" + item[200:] + chars(50)
    assert dec.banded_alignment(item, text, 0, 6100, 20) == (2, 6000, 6300)


def test_place_of_short_items_and_a_very_long_text(spark, docs_of):
    rng = random.Random(3)
    filler = " ".join("".join(rng.choice("xyz") for _ in range(5)) for _ in range(200_000))
    bench = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "the quick brown fox jumps over")], "item_id long, text string")
    text = filler + " a b the quick brown fox jumps over"
    got = dec.contaminated(docs_of([(5, text), (6, filler)]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.edits) for r in got) == [
        (5, 1, 200_000, 2, 0), (5, 2, 200_000, 2, 0), (5, 3, 200_002, 6, 0)]
