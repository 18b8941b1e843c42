"""Quality classifier from weak labels.

* Labellers: overlapping heuristics, each votes good (+1), bad (-1) or
  abstains (0) on measures of a whole text.
* Label model: expectation-maximisation over each labeller's votes in either
  class (its accuracy) and the class share.  It needs only how many
  documents show each vote pattern, counted over the whole corpus; with ten
  labellers at most 3^10 patterns reach the driver.
* Scorer: the posterior of a document's votes is its training label for a
  linear scorer over hashed features (word shapes and binned measures),
  fitted by gradient descent on at most ``FIT_ROWS`` documents, those with the
  smallest hash of id and text; every document is scored.

Defined results: a null text is empty; every row is scored, repeated ones and
null ids too; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import map_rows, text_of

FIT_ROWS = 20_000
DIM = 1 << 14
SHARE_GOOD = 0.8        # start of the label model
#: The labellers are written to be precise: at most this share of good texts
#: gets a bad vote of one of them.  Kinds of junk rarely overlap, so without
#: this bound the model would call the commonest kind bad and the rest good.
FALSE_ALARMS = 0.001

_SIGNS = frozenset(b"#$%&*@^~<>{}[]\\_=+`")
#: Byte classes of word shapes: a lower case or beyond ASCII, A upper case, 0 digit; signs stay.
_SHAPE = bytes(97 if b >= 128 or 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_NOT_SIGN = bytes(b for b in range(256) if b not in _SIGNS)
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)

#: Names in the order of the votes.
LABELLERS = ["signs", "shouting", "exclamation", "top_word", "variety", "separators", "line_ends", "length", "word_length", "repeated_lines"]


def measures(text: str) -> tuple[dict[str, float], list[bytes]]:
    """Shares between 0 and 1 (and counts) that labellers and features read."""
    from collections import Counter
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, sum(map(len, words)))
    count = Counter(words)
    upper, lower = len(data.translate(None, _NOT_UPPER)), len(data.translate(None, _NOT_LOWER))
    return {
        "words": len(words),
        "signs": len(data.translate(None, _NOT_SIGN)) / size,
        "upper": upper / max(1, upper + lower),
        "exclaim": data.count(b"!!") / n,
        "top": max((x for w, x in count.items() if w != b"|"), default=0) / n,
        "distinct": len(count) / n,
        "same": sum(map(bytes.__eq__, words, words[1:])) / n,
        "bars": count[b"|"] / n,
        "ends": sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"', b")") for x in lines) / max(1, len(lines)),
        "mean": len(text) / n,
        "lines": len(lines),
        "line_repeats": 1 - len(set(lines)) / max(1, len(lines)),
    }, words


def votes(m: dict[str, float]) -> list[int]:
    some, many = m["words"] >= 20, m["words"] >= 100
    bad = lambda x: -1 if x else 0
    return [
        bad(m["signs"] >= 0.10),
        bad(some and m["upper"] >= 0.5),
        bad(m["exclaim"] >= 0.2),
        bad(some and m["top"] >= 0.25),
        bad(many and m["distinct"] <= 0.1),
        bad(some and m["bars"] >= 0.1),
        1 if m["ends"] >= 0.7 else bad(some and m["ends"] <= 0.2),
        1 if m["words"] else -1,
        1 if 2 <= m["mean"] <= 14 else -1,
        bad(m["lines"] >= 5 and m["line_repeats"] >= 0.4),
    ]


class LabelModel:
    """Class share and, per labeller, how often it votes good, votes bad or
    abstains on texts of either class; a vote weighs as their ratio."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200):
        import numpy as np
        k = len(LABELLERS)
        v = np.array([p for p, _ in patterns], dtype=int).reshape(-1, k)
        n = np.array([c for _, c in patterns], dtype=float)
        self.share = SHARE_GOOD
        # rate[class bad/good, labeller, vote -1/0/+1]; a bad vote starts as a strong hint, a good one as a weak one
        start = np.array([[0.3, 0.1, 0.6], [FALSE_ALARMS, 0.1, 0.9]])[:, None, :]
        self.rate = np.repeat(start, k, axis=1)
        for _ in range(rounds if len(n) else 0):
            p = self.posterior(v)
            before = self.share
            self.share = float(np.clip((n * p).sum() / n.sum(), 0.02, 0.98))
            for c, w in ((0, n * (1 - p)), (1, n * p)):
                for x in (-1, 0, 1):
                    # ten pseudo-documents at the start rates
                    self.rate[c, :, x + 1] = ((w[:, None] * (v == x)).sum(axis=0) + 10 * start[c, 0, x + 1]) / (w.sum() + 10)
            self.rate[1, :, 0] = np.minimum(self.rate[1, :, 0], FALSE_ALARMS)
            self.rate[1] /= self.rate[1].sum(axis=1, keepdims=True)
            if abs(before - self.share) < 1e-10:
                break

    def posterior(self, v):
        """Chance that documents with these votes are good."""
        import numpy as np
        v = np.asarray(v, dtype=int).reshape(-1, len(LABELLERS))
        ratio = np.log(self.rate[1] / self.rate[0])
        odds = ratio[np.arange(len(LABELLERS)), v + 1].sum(axis=1) + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracies(self) -> dict[str, float]:
        """Share of right votes among the votes of each labeller."""
        joint = [(1 - self.share) * self.rate[0], self.share * self.rate[1]]
        right, wrong = joint[0][:, 0] + joint[1][:, 2], joint[0][:, 2] + joint[1][:, 0]
        return {k: float(x) for k, x in zip(LABELLERS, right / (right + wrong))}


def hashed_features(m: dict[str, float], words: list[bytes], memory: dict[bytes, int], dim: int = DIM) -> dict[int, float]:
    """Square roots of the shares of collapsed word shapes, and one feature
    for the bin of each measure, at hashed places."""
    import re
    import zlib
    from collections import Counter
    out: dict[int, float] = {}
    for shape, n in Counter(b" ".join(words).translate(_SHAPE).split()).items():
        at = memory.get(shape)
        if at is None:
            at = zlib.crc32(b"shape " + re.sub(rb"(.)\1+", rb"\1", shape)) % dim
            if len(memory) < 100_000:
                memory[shape] = at
        out[at] = out.get(at, 0.0) + n / len(words)
    out = {i: x ** 0.5 for i, x in out.items()}
    for k, x in m.items():
        level = min(int(x).bit_length(), 4) if k in ("words", "lines", "mean") else int(x * 8)
        i = zlib.crc32(f"{k} {level}".encode()) % dim
        out[i] = out.get(i, 0.0) + 0.5
    return out


def fit_scorer(rows: list[tuple[dict[int, float], float]], dim: int = DIM, rounds: int = 300, rate: float = 0.5, pull: float = 1e-4):
    """Weights (the last is the offset) of a logistic scorer on soft labels,
    by gradient descent with per-weight steps."""
    import numpy as np
    if not rows:
        return np.zeros(dim + 1)
    of = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    at = np.array([i for f, _ in rows for i in f], dtype=np.int64)
    x = np.array([v for f, _ in rows for v in f.values()])
    y = np.array([p for _, p in rows])
    w, b, seen, seen_b = np.zeros(dim), 0.0, np.full(dim, 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, x * w[at], len(rows)) + b, -30, 30)))
        err = (p - y) / len(rows)
        g = np.bincount(at, x * err[of], dim) + pull * w
        gb = err.sum()
        seen += g * g
        seen_b += gb * gb
        w -= rate * g / np.sqrt(seen)
        b -= rate * gb / seen_b ** 0.5
    return np.r_[w, b]


def vote_patterns(docs: DataFrame) -> DataFrame:
    """votes array<int>, n: documents of the corpus by vote pattern."""
    def run(batches):
        from collections import Counter
        n: Counter = Counter()
        for b in batches:
            n.update(tuple(votes(measures(t.as_py())[0])) for t in b.column(1))
        yield list(n.items())
    return map_rows(text_of(docs), run, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[LabelModel, object]:
    """Label model over the whole corpus, scorer on a bounded sample."""
    patterns = sorted((tuple(r["votes"]), r["n"]) for r in vote_patterns(docs).collect())
    model = LabelModel(patterns)
    base = text_of(docs)
    order = [F.xxhash64("doc_id", "text"), F.col("doc_id")]
    # the sample is chosen by hash alone, texts are read for chosen rows only
    cut = base.select(*[c.alias(f"o{i}") for i, c in enumerate(order)]).orderBy("o0", "o1").limit(fit_rows).agg(F.max("o0").alias("m")).first()["m"]

    def run(batches):
        memory: dict[bytes, int] = {}
        for b in batches:
            rows = []
            for t in b.column(1):
                m, words = measures(t.as_py())
                f = hashed_features(m, words, memory)
                rows.append((list(f), list(f.values()), votes(m)))
            yield rows

    sample = base.where(order[0] <= F.lit(cut)) if cut is not None else base.limit(0)
    got = map_rows(sample, run, "at array<int>, x array<double>, votes array<int>").limit(fit_rows).collect()
    got.sort(key=lambda r: (r["at"], r["x"]))
    p = model.posterior([r["votes"] for r in got]) if got else []
    return model, fit_scorer([(dict(zip(r["at"], r["x"])), float(q)) for r, q in zip(got, p)])


def quality(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, score (chance of good text), kept (score >= 0.5), weak_label
    (posterior of the votes) and votes (in the order of ``LABELLERS``)."""
    model, weights = fit(docs, fit_rows)

    def run(batches):
        import math
        memory: dict[bytes, int] = {}
        w = weights.tolist()
        for b in batches:
            rows, vs = [], []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                m, words = measures(t.as_py())
                z = w[-1] + sum(w[i] * x for i, x in hashed_features(m, words, memory).items())
                score = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
                vs.append(votes(m))
                rows.append((doc, score, score >= 0.5))
            p = model.posterior(vs) if vs else []
            yield [(*r, float(q), v) for r, q, v in zip(rows, p, vs)]

    return map_rows(text_of(docs), run, "doc_id long, score double, kept boolean, weak_label double, votes array<int>")
