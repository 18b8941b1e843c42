import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tesoro.llm import token_alignment as ta
from tesoro.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a", "a ", "a  b", "a \n b", "\n\n x\t y", "it's don't we'll", "x<|endoftext|>y <|endoftext|> z", "<s> </s> <unk> <0x41>",
       "▁a b", "a▁ b c", "a▁b", "日本語 テスト 12", "🙂🙂 a🙂 🙂", "é ́x", "a b  c", "a\x1c b\x85 c", "x" * 500,
       "a" * 31 + " b", "  " * 40 + "q", "\x00 a \x00b", "_a _b __ 1_2 ½ x² Ⅷ", "​ a​ b", "ﬁ ﷽ ǆ", "| a | b || c", "-- a --b", "٠ ١ a", "﻿ a"]


def brute(rows):
    """Straight from the definition, whole texts, no remembered parts."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    own = ta.byte_level_bytes()
    out, linked = [], []
    for doc, text in rows:
        if not text:
            out.append((doc, 0, 0, [], ""))
            linked.append(Counter())
            continue
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx = [bytes(own[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        if b"".join(bx) != (" " + text).encode() or b"".join(by) != (" " + text).encode():
            out.append((doc, 0, 0, [], ""))
            linked.append(Counter())
            continue
        ends = [[sum(map(len, z[:1]))] for z in (bx, by)]
        for z, e in zip((bx, by), ends):
            for t in z[1:]:
                e.append(e[-1] + len(t))
        stops, groups, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for s in stops:
            i2, j2 = ends[0].index(s, i) + 1, ends[1].index(s, j) + 1
            groups.append((x[i:i2], y[j:j2]))
            i, j = i2, j2
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc, len(x), len(y), groups, hashlib.sha256(text.encode()).hexdigest()))
        linked.append(Counter((p, q) for g, h in groups for p in g for q in h))
    count = Counter(k for c in linked for k in c)
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    return [(doc, n_a, n_b, len(groups), sum(c.values()), sum(n for k, n in c.items() if count[k] == best[k[0]]),
             sum(n * count[k] for k, n in c.items()), sha) for (doc, n_a, n_b, groups, sha), c in zip(out, linked)]


def key(r):
    return tuple(str(x) for x in r)


def test_galloping_equals_the_sets():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(1, 200), rng.choice([0, 1, 3, 40, 150]))) for _ in range(2))
        i, j = ta.common_ends(np.array(a, int), np.array(b, int))
        assert list(zip(i.tolist(), j.tolist())) == [(a.index(x), b.index(x)) for x in sorted(set(a) & set(b))]


def test_wide_groups_count_the_same(monkeypatch):
    texts = ["plain words and " + "ab" * 40 + " more", "日本語テスト" * 9, "", "▁ x"]
    want = ta.Aligner(A, B).align(texts)
    monkeypatch.setattr(ta, "WIDE_LINKS", 0)
    assert all(list(x) == list(y) for x, y in zip(ta.Aligner(A, B).align(texts), want))


def test_odd_texts_equal_brute_force(spark, docs_of):
    rng = random.Random(8)
    bits = ["a", "the", " ", " ", "  ", "\n", "é", "12", "_", "'s", "|", "日", "🙂", "▁", "\t", " ", "Ünder", "-", "́", "."]
    rows = list(enumerate(ODD)) + [(1000 + i, "".join(rng.choices(bits, k=rng.randint(1, 30)))) for i in range(400)]
    rows += [(None, "a null id"), (3, "a second text"), (3, "a second text"), (5000, "lorem ipsum dolor " * 40_000)]
    want = sorted(brute(rows), key=key)
    for hot in (ta.HOT, 5):
        assert sorted((tuple(r) for r in ta.alignment(docs_of(rows), A, B, hot=hot).collect()), key=key) == want
    assert ta.alignment(docs_of([]), A, B).collect() == []


def test_corpus_equals_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in ta.alignment(docs, A, B).collect()), key=key) == sorted(brute(rows), key=key)


def test_groups_are_the_texts_tokens(spark, docs_of):
    got = {r.doc_id: r for r in ta.token_groups(docs_of([(1, "unbelievable tokenizers"), (2, None)]), A, B).collect()}
    a = Tokenizer.from_file(A).encode(" unbelievable tokenizers", add_special_tokens=False).ids
    assert [int(i) for g in got[1].groups.split(";") for i in g.split("|")[0].split(",")] == a
    assert got[1].n_a == len(a) and got[1].n_groups >= 2 and got[2].groups == "" and got[2].n_links == 0
