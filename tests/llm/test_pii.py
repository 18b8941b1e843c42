import collections
import hashlib
import math
import random
import re

from tesoro.llm import pii

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+".replace(r"[\x20-]", "[ -]")), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d))))
        return 12 <= len(d) <= 19 and s % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def base(text):
    out = [(m.start(), r, k, m.end()) for r, (k, p) in enumerate(BASE) for m in re.finditer(p, text) if ok(k, m[0])]
    return sorted(out)


def all_spans(rows):
    """Brute force over distinct (id, text) rows for terms, all rows for counts."""
    texts = [(d, t or "") for d, t in rows]
    df = collections.Counter()
    for _, t in texts:
        df.update(set(re.split(r"[\W_]+", t.lower())))
    held, beside = collections.defaultdict(set), collections.defaultdict(set)
    places = {}
    for key in set(texts):
        b = base(key[1])
        by_kind = collections.defaultdict(list)
        for r, (k, p) in enumerate(BASE):
            by_kind[k] = [m.span() for m in re.finditer(p, key[1])]
        own = []
        for s, _, k, e in b:
            entity = key[1][s:e].lower()
            held[entity].add(key)
            i = by_kind[k].index((s, e))
            lo = by_kind[k][i - 1][1] if i else 0
            hi = by_kind[k][i + 1][0] if i + 1 < len(by_kind[k]) else len(key[1])
            l0, r1 = max(lo, s - pii.CONTEXT), min(hi, e + pii.CONTEXT)
            for a, z in ((l0, s), (e, r1)):
                for m in re.finditer(r"[^\W_]+", key[1][a:z]):
                    x, y = a + m.start(), a + m.end()
                    if z - a >= pii.CONTEXT and (a == l0 and z == s and m.start() == 0 or a == e and m.end() == z - a):
                        continue
                    if not any(p0 < y and p1 > x for p0, _, _, p1 in b):
                        own.append((entity, m[0].lower(), x, y))
                        beside[entity, m[0].lower()].add(key)
        places[key] = own
    told = set()
    for (entity, term), keys in beside.items():
        if len(keys) >= pii.MIN_DOCS:
            share = min(1.0, len(keys) / df[term])
            if share >= pii.MIN_SHARE and math.log2(share / (len(held[entity]) / len(texts))) >= pii.MIN_BITS:
                told.add((entity, term))
    return [(d, base(t), sorted(set(base(t)) | {(x, 4, "term", y) for e, w, x, y in places[d, t] if (e, w) in told})) for d, t in texts]


def text(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def cases():
    rng = random.Random(6)
    bits = ["a@b.co", "x.y+z%1@mail-1.example.com", "@no.pe", "a@b", "1.2.3.4", "999.1.1.1", "1.2.3.4.5", "001.002.003.255", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (555) 123-4567", "+1 2", "++49 30 1234567.", "é😀", "word", "Other", "\n", "under_score", "12345678901234567890", "5500000000000004"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice([" ", "", ", ", "|"]) for _ in range(rng.choice([1, 5, 40])))) for i in range(150)]
    for i in range(200, 206):
        rows.append((i, f"plain words here about Zorblatt and Quux for jo@corp.example {'pad ' * 60} end {i}"))
    rows += [(i, f"filler number {i} about plain words only and more") for i in range(300, 380)]
    rows += [(400, None), (401, ""), (None, "me@x.org 😀 me@x.org"), (3, rows[3][1]), (402, "1" * 3000 + " " + "a" * 3000 + "@" + "+1 23456789 " * 300),
             (403, "1 2 " * 4000), (404, "a.b@" * 2000), (405, "1." * 4000 + "x@y.z.w_q@a.b"), (406, "x@" + "a." * 5000 + "b")]
    return rows


def test_matches_brute_force(spark, docs_of):
    rows = cases()
    found = pii.personal_data(docs_of(rows))
    got = sorted((tuple(r) for r in pii.digest(found).collect()), key=str)
    want = sorted(((d, *[sum(s[2] == k for s in b) for k in pii.KINDS], hashlib.sha256(text(b).encode()).hexdigest(), text(a))
                   for d, b, a in all_spans(rows)), key=str)
    for g, w in zip(got, want):
        assert g == w
    assert len(got) == len(want)
    assert any("term" in g[-1] for g in got)
    clean = {r.doc_id: r.text for r in pii.redact(docs_of(rows), found).collect()}
    assert clean[None] == "<EMAIL> 😀 <EMAIL>" and clean[400] == "" and "<TERM>" in clean[200] and "Zorblatt" not in clean[200]


def test_empty_table(docs_of):
    assert pii.digest(pii.personal_data(docs_of([]))).collect() == []


def whole_spans(rows):
    """Brute force: every free word of a document counts with every entity, every place of a told term is a span."""
    texts = [(d, t or "") for d, t in rows]
    word = re.compile(r"[^\W_]+")
    df, held, both = collections.Counter(), collections.defaultdict(set), collections.defaultdict(set)
    for _, t in texts:
        df.update({m[0].lower() for m in word.finditer(t)})
    free = lambda t, b: [(m[0].lower(), *m.span()) for m in word.finditer(t) if not any(s < m.end() and e > m.start() for s, _, _, e in b)]
    for key in set(texts):
        b = base(key[1])
        for e in {key[1][s:z].lower() for s, _, _, z in b}:
            held[e].add(key)
            for w in {w for w, _, _ in free(key[1], b)}:
                both[e, w].add(key)
    told = set()
    for (e, w), keys in both.items():
        share = min(1.0, len(keys) / df[w])
        if len(keys) >= pii.MIN_DOCS and share >= pii.MIN_SHARE and math.log2(share / (len(held[e]) / len(texts))) >= pii.MIN_BITS:
            told.add(w)
    return [(d, base(t), sorted(base(t) + [(x, 4, "term", y) for w, x, y in free(t, base(t)) if w in told])) for d, t in texts]


def far_cases():
    far = "plain words only and more " * 12
    rows = [(i, f"Xanadu {far} jo@far.example end {i} \ue000Xanadu éjo@far.example") for i in range(500, 504)]
    return cases() + rows + [(510, "no entity, but XANADU\ue000is named"), (511, "1987 12 Karlsplatz 4111 1111 1111 1111 x"), (512, None)]


def test_whole_documents_match_brute_force(docs_of):
    rows = far_cases()
    found = pii.personal_data(docs_of(rows), whole=True)
    got = sorted((tuple(r) for r in pii.digest(found).collect()), key=str)
    want = sorted(((d, *[sum(s[2] == k for s in b) for k in pii.KINDS], hashlib.sha256(text(b).encode()).hexdigest(), text(a))
                   for d, b, a in whole_spans(rows)), key=str)
    for g, w in zip(got, want):
        assert g == w
    assert len(got) == len(want)
    clean = {r.doc_id: r.text for r in pii.redact(docs_of(rows), found).collect()}
    assert "Xanadu" not in clean[500] and "XANADU" not in clean[510]
    assert pii.digest(pii.personal_data(docs_of([]), whole=True)).collect() == []
