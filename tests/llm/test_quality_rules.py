import random
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tesoro.llm import quality_rules as qr
from tesoro.llm.common import table

D = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = list(zip(words, words[1:], words[2:]))
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines, seen = 0, set()
    for x in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            lines += x in seen
            seen.add(x)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(hit), failed


def test_odd_texts_have_the_base_measures_of_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(2)
    bits = ["a", "b", "ab", "é", "日本", " ", "\n", "\t", "\x0b", " ", "\x1c", "\x85", "|", "#", "<", "🙂"]
    rows = [(i, "".join(rng.choices(bits, k=rng.choice([0, 3, 20, 400])))) for i in range(300)]
    rows += [(None, "x y z"), (400, None), (401, ""), (402, " \n \n "), (403, "spam word " * 100_000), (404, "a a a a"), (404, "a a a a"), (405, "a a a"),
             (406, " ".join(f"w{i}" for i in range(300_000)) + " w0 w1 w2")]
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(0, 300, 3)] + [(None, 1, 0, None), (5, None, 0, None), (404, 1, 0, ""), (404, 0, 1, "")], LABELS)
    got = qr.quality_rules(docs_of(rows), labels).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(((d, *brute(t)) for d, t in rows), key=key)
    assert all(0 <= r.score <= 1 and not (r.base_failed and r.kept) for r in got)
    assert all(r.kept == (not r.base_failed and r.score >= 0.5) for r in got)
    none = qr.quality_rules(docs_of(rows), labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.kept != r.base_failed for r in none)
    assert all(r.score > 0.9 for r in qr.quality_rules(docs_of(rows), labels.where("quality = 1")).collect())
    assert qr.quality_rules(docs_of([]), labels).collect() == [] == qr.quality_rules(docs_of([]), labels.limit(0)).collect()


def test_large_word_numbers_stay_exact():
    ids = np.random.default_rng(1).integers(0, 1 << 40, 50)
    ids = np.r_[ids, [5, 6, 7, 8], ids[10:13], ids[10:14]] % (1 << 30)
    n = Counter(zip(ids.tolist(), ids[1:].tolist(), ids[2:].tolist()))
    want = {i + k for i in range(len(ids) - 2) if n[tuple(ids[i:i + 3].tolist())] > 1 for k in range(3)}
    assert qr._windows_twice(ids) == len(want)


def test_base_measures_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    names = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"
    want = sorted(con.sql(f"SELECT {names} FROM ({qr.BASE_SQL})").fetchall())
    got = qr.quality_rules(table(spark, D, "documents"), table(spark, D, "labels"), per_class=50)
    assert sorted(tuple(r)[:7] for r in got.collect()) == want


def test_margins_are_the_dot_product_of_features():
    w = np.random.default_rng(3).normal(size=len(qr.FAMILIES) * qr.DIM + 1)
    texts = ["", "a", "ab cd", "abc", "Some words, some more words\nand a line.", "é 日本 é 日本"]
    for m in qr.measured(texts):
        want = [sum(w[i] * x for i, x in zip(*f)) + w[-1] for f in qr.features(m)]
        assert np.allclose(qr.margins(m, w), want)


def test_held_out_labels_are_met_and_probabilities_calibrated(spark):
    docs, labels = table(spark, D, "documents"), table(spark, D, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    found = qr.quality_rules(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    good, bad = [r for r in found if r.quality == 1], [r for r in found if r.quality == 0]
    assert len(bad) > 80 and len(good) > 500
    assert np.mean([r.score >= 0.5 for r in good]) > 0.99 and np.mean([r.score >= 0.5 for r in bad]) < 0.05
    assert abs(np.mean([r.score for r in found]) - np.mean([r.quality for r in found])) < 0.03
    assert np.mean([(r.score - r.quality) ** 2 for r in found]) < 0.02


def test_features_reach_the_driver_as_bytes(spark, docs_of, monkeypatch):
    seen, real = [], qr.map_rows
    monkeypatch.setattr(qr, "map_rows", lambda df, fn, ddl: seen.append(ddl) or real(df, fn, ddl))
    docs = docs_of([(i, f"word{i % 3} text {i} of it") for i in range(20)] + [(20, ""), (21, None)])
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(22)], LABELS)
    model = qr.fit(docs, labels)
    assert len(seen) == 1 and "array" not in seen[0]
    assert np.isfinite(model.weights).all() and np.abs(model.weights).max() > 0
