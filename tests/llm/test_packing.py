import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tesoro.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [0]


def test_plan_places_every_piece_once_without_overflow():
    rng = random.Random(5)
    for _ in range(30):
        cap = rng.choice([10, 64, 2048])
        counts = {rng.randint(1, cap): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        bins = {}
        seen = {}
        for length, rank0, n, seq0, offset in packing.plan(counts, cap):
            for i in range(n):
                seen.setdefault(length, []).append(rank0 + i)
                bins.setdefault(seq0 + i, []).append((offset, length))
        assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(c)) for n, c in counts.items()}
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= cap
            assert sum(3 * length > cap for _, length in own) <= 2
        total = sum(n * c for n, c in counts.items())
        assert len(bins) <= max(1, int(11 / 9 * -(-total // cap)) + 1 + sum(c for n, c in counts.items() if 2 * n > cap))


def test_large_items_are_matched():
    assert len({s + i for _, _, n, s, _ in packing.plan({6: 1, 5: 1, 4: 1, 3: 1}, 9) for i in range(n)}) == 2


def test_encoder_equals_the_tokenizer():
    encode = packing.encoder(FILE)
    texts = ["", " ", "Hello, WORLD!!", "it's don't CAN'T", "a\tb\x0bc d e\x1cf", "É é ΟΔΟΣ İstanbul ﬁ", "x<|endoftext|>y <|endoftext|>",
             "12 3.4,5 cọ́", "日本語 テスト", "á! b,́ ñ.", "ab'll we're ''s", "a  \n\n b\r\nc", "$$$word%%% WORD.## 🙂🙂 a🙂"]
    for own in (texts, texts[::-1], [t.upper() + "..." for t in texts], ["a\n\nb"], []):
        for at in range(min(2, len(own) + 1)):
            flat, begins = encode(pa.array(["x"] * at + own, pa.string()).slice(at))
            assert len(begins) == len(own) + 1
            for t, x, y in zip(own, begins, begins[1:]):
                assert flat[x:y].tolist() + [0] == ids_of(t), repr(t)


def test_query_matches_brute_force(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta.", "Gamma", "d'or", "é"]) for _ in range(rng.choice([0, 3, 50, 700, 3000])))) for i in range(40)]
    rows += [(41, None), (None, "null id"), (3, rows[3][1]), (3, "other text")]
    got = packing.best_fit_packing(docs_of(rows), FILE).collect()
    want = []
    for d, t in rows:
        ids = ids_of(t)
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at:at + 2048]
            want.append((d, k, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(x[3] for x in want) / 2048 * 1.1 + 2


def test_empty_table(docs_of):
    assert packing.best_fit_packing(docs_of([]), FILE).collect() == []


def test_slices_do_not_change_the_result(spark):
    pieces = spark.range(500).selectExpr("id AS doc_id", "0 AS piece", "CAST(1 + id % 3 AS long) AS length")
    for rows in (10, 1000):
        got = packing.pack(pieces, 8, rows).collect()
        bins = {}
        for r in got:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(got) == 500 and all(sum(n for _, n in b) <= 8 for b in bins.values())
        assert len(bins) == -(-sum(r.length for r in got) // 8)
