import random
import re

from tesoro.llm import licenses as lic

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(doc, text):
    words = words_of(text)
    places, base = [], set()
    for phrase, label in lic.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    labels, best = set(base), 0.0
    for at in range(0, len(words), lic.STEP):
        block = set(words[at:at + 2 * lic.STEP])
        for label, notice in lic.TEMPLATES:
            t = set(words_of(notice))
            c = len(t & block) / len(t)
            if len(t & block) * 1000 >= round(lic.THRESHOLD * 1000) * len(t):
                labels.add(label)
                best = max(best, c)
    return (doc, len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best)


def test_scan_matches_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocab = ["the", "under", "license", "of", "mit", "cc", "by", "é", "x", "gnu", "public", "software"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 60, 300]))]
        if i % 3 == 0:
            label, notice = rng.choice(lic.TEMPLATES)
            cut = notice.split()
            for _ in range(rng.randint(0, 3)):
                cut.pop(rng.randrange(len(cut)))
            words[len(words) // 2:len(words) // 2] = cut
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(100, None), (101, ""), (None, "Apache License, cc-BY"), (5, rows[5][1]), (102, "mit license mit license " * 2000)]
    got = sorted((tuple(r)[:8] for r in lic.license_scan(docs_of(rows)).collect()), key=str)
    assert got == sorted((brute(*r) for r in rows), key=str)


def test_empty_table(docs_of):
    assert lic.license_scan(docs_of([])).collect() == []


def test_marks_tell_sibling_notices_apart(docs_of):
    rows = [(1, "Licensed under the GNU General Public License."), (2, "Licensed under CC BY-NC 4.0"), (3, "Licensed under CC BY 4.0"),
            (4, "This work is licensed under the GNU Lesser General Public License version 3"), (5, "licensed under the GNU Affero General Public License"),
            (6, "Licensed under CC BY-SA 3.0"), (7, "licensed under CC BY-NC-SA 4.0"), (8, "released mit under the new license"),
            (9, "Released under the MIT License"), (10, "sa mère: licensed under CC BY 4.0"), (11, lic.TEMPLATES[1][1])]
    got = {r.doc_id: r.labels for r in lic.license_scan(docs_of(rows), marks=lic.MARKS).collect()}
    assert got == {1: "gpl", 2: "cc-by,cc-by-nc", 3: "cc-by", 4: "lgpl", 5: "agpl", 6: "cc-by,cc-by-sa", 7: "cc-by,cc-by-nc,cc-by-sa", 8: "",
                   9: "mit", 10: "cc-by", 11: "mit"}


def test_query_uses_marks(spark):
    from tesoro.llm.queries import QUERIES
    labels = [(set(filter(None, r.base_labels.split(","))), set(filter(None, r.labels.split(",")))) for r in QUERIES["op3_license_scans"](spark, "/root/testdata/sf0.01").collect()]
    assert any("gpl" in b for b, _ in labels)
    assert not any({"lgpl", "agpl"} <= a or {"cc-by-sa", "cc-by-nd"} <= a for _, a in labels)
