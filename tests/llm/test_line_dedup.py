import hashlib
import random

from tesoro.llm import line_dedup as ld


def cut(text):
    """Chunks (lists of lines) of a text."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    out, prev = [[]], None
    for line in text.split("\n"):
        if out[-1] and len(out) and getattr(cut, "end", False):
            out.append([])
        out[-1].append(line)
        cut.end = prev is not None and md5(md5(prev) + md5(line))[0] < "5"
        prev = line
    cut.end = False
    return out


def brute(rows):
    """(doc_id, text) -> kept text, rows of distinct (id, text)."""
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None:
            out[d, t] = None
            continue
        kept = []
        for c in cut(t):
            if len(c) >= ld.MIN_LINES and tuple(c) in seen:
                continue
            seen.add(tuple(c))
            kept += c
        out[d, t] = "\n".join(kept)
    return out


def test_matches_brute_force(spark, docs_of):
    rng = random.Random(8)
    shared = [[f"shared {g} {i}" for i in range(12)] for g in range(5)]
    rows = []
    for i in range(80):
        lines = [rng.choice(["", "|", "x\r", "é|", " y"]) + str(rng.randint(0, 400)) for _ in range(rng.randint(0, 15))]
        at = rng.randint(0, len(lines))
        lines[at:at] = rng.choice(shared)[: rng.randint(2, 12)] + rng.choice(["", "same\nsame\nsame\nsame", "\n\n\n"]).split("\n")
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n"), (103, rows[4][1]), (7, rows[7][1]), (None, rows[9][1]), (104, "\n".join(["r"] * 5000))]
    out = ld.line_dedup(docs_of(rows))
    assert out.columns == docs_of([]).columns + ["_n_lines", "n_removed", "n_chunks"]
    want = brute(rows)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(((d, want[d, t]) for d, t in rows), key=str)
    assert sum(r.n_removed for r in out.collect()) > 100
    for r in out.collect():
        if r.text is not None and r.n_removed == 0:
            assert (r.doc_id, r.text) in rows


def test_empty_table_and_nothing_repeated(docs_of):
    assert ld.line_dedup(docs_of([])).collect() == []
    rows = [(1, "a\nb\nc"), (2, "d\ne")]
    assert sorted((r.doc_id, r.text) for r in ld.line_dedup(docs_of(rows)).collect()) == rows


def brute_runs(rows):
    """(doc_id, text) -> text without the lines of any pair that stands earlier, not overlapping it."""
    places, out = {}, {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for n, (_, t) in enumerate(order):
        lines = [] if t is None else t.split("\n")
        for i, pair in enumerate(zip(lines, lines[1:])):
            places.setdefault(pair, (n, i))
    for n, (d, t) in enumerate(order):
        lines, gone = [] if t is None else t.split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if places[pair] not in ((n, i), (n, i - 1)):
                gone |= {i, i + 1}
        out[d, t] = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_whole_runs_go_with_their_edges(docs_of):
    rng = random.Random(9)
    shared = [[f"shared {g} {i}" for i in range(12)] for g in range(5)]
    rows = []
    for i in range(60):
        lines = [rng.choice(["", "|", "x\r", "é|"]) + str(rng.randint(0, 4000)) for _ in range(rng.randint(0, 9))]
        at, g, n = rng.randint(0, len(lines)), rng.randrange(5), rng.randint(2, 6)
        start = rng.randint(0, 12 - n)
        lines[at:at] = shared[g][start:start + n]
        rows.append((i, "\n".join(lines)))
    rows += [(90, "a\nfirst\nsecond\nb"), (91, "c\nfirst\nsecond\nd"), (92, "r\nr\nr\nr\nr"), (93, "r\nr\nr"), (100, None), (101, ""),
             (102, "\n"), (103, "\n"), (7, rows[7][1]), (None, rows[9][1])]
    got = ld.line_dedup(docs_of(rows), whole_runs=True).collect()
    want = brute_runs(rows)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((d, want[d, t]) for d, t in rows), key=str)
    by = {r.doc_id: r for r in got}
    assert by[91].text == "c\nd" and (by[91].n_removed, by[91].n_chunks) == (2, 1) and by[92].text == "r\nr" and by[93].text == ""
    # a line that goes still stands somewhere
    assert {x for _, t in rows if t for x in t.split("\n")} <= {x for r in got if r.text is not None for x in r.text.split("\n")}
