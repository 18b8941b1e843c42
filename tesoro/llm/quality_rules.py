"""Quality rules: base measures of whole texts and a calibrated classifier.

* Base measures: words, their code points, signs, lines that repeat an earlier
  line, and words within 3-word windows that stand twice or more.  Windows are
  compared by exact word numbers, not by hashes.
* Classifier: logistic regression on hashed n-grams, ``FAMILIES``: one and two
  words (a word twice in a row is the same n-gram for every word), three and
  four bytes.  A feature is the share of a text's n-grams of
  its family that fall into one of ``DIM`` places, so a score is a sum of means
  of weights, taken over array batches.  It is fitted on at most ``PER_CLASS``
  labelled documents a class (the smallest hashes of ids), both classes with
  the same weight.
* Calibration: one of ``FOLDS`` of those documents is kept from the fit; on it
  a logistic curve (Platt's, with smoothed targets) turns margins into
  probabilities, weighted by the classes' shares among all labelled documents.
* Verdict: kept if the base rules hold and the probability is ``KEEP`` or more.

Bounds: the fit holds at most 2 x PER_CLASS x 4 x DIM features on the driver.
Everything else covers all rows and whole texts.

Defined results: a null text is empty (no words, fails the base rules); every
row is scored, repeated rows and null ids too; a doc_id labelled both ways
counts as bad, one that names several texts is fitted on the smallest; null
labels are none; without labels of either class the score is the share of good
ones (0.5 without any labels), so base rules decide alone; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import map_rows, text_of

PER_CLASS = 1_000
FOLDS = 5
BITS = 13
DIM = 1 << BITS
FAMILIES = ("word", "two words", "three bytes", "four bytes")
LEAST_WORDS = 50
MOST_REPEATED = 50      # per cent of the words
KEEP = 0.5
#: Bytes of text measured together.
GROUP_BYTES = 2_000_000
_BLANK = b" \t\n\x0b\x0c\r"
_SIGNS = b"#*$%&|<>"


class Measured(NamedTuple):
    """Measures of a group of texts, one row a text, and per family the place
    of each n-gram and where each text's begin and end."""
    base: list[tuple[int, int, int, int, int]]
    grams: list[tuple]


def _windows_twice(ids) -> int:
    """Words within 3-word windows that stand twice or more in the text."""
    import numpy as np
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    pair = ids[:-1] * size + ids[1:]
    if size >= 1 << 20:     # keeps the number of a window within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * size + ids[2:]
    order = np.sort(window)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, which, n = np.unique(window, return_inverse=True, return_counts=True)
    twice = n[which] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k:len(window) + k] |= twice
    return int(hit.sum())


def measured(texts: list[str]):
    """Groups of ``GROUP_BYTES`` as ``Measured``, texts in their order."""
    group, size = [], 0
    for t in texts:
        data = t.encode("utf-8", "surrogatepass")
        if group and size + len(data) > GROUP_BYTES:
            yield _group(group)
            group, size = [], 0
        group.append((len(t), data))
        size += len(data)
    if group:
        yield _group(group)


def _group(group: list[tuple[int, bytes]]) -> Measured:
    import zlib

    import numpy as np

    class Numbers(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    numbers, base, ids, texts = Numbers(), [], [], [data for _, data in group]
    for points, data in group:
        words = data.split()
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        lines = [x for x in data.split(b"\n") if x and not x.isspace()]
        base.append((len(words), points - len(data) + len(data.translate(None, _BLANK)), len(data) - len(data.translate(None, _SIGNS)),
                     len(lines) - len(set(lines)), _windows_twice(own)))
        ids.append(own)
    codes = np.fromiter(map(zlib.crc32, numbers), np.uint32, len(numbers))
    word = codes[np.concatenate(ids)]
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    shift, mix = np.uint32(32 - BITS), np.uint32(2654435761)

    def ranges(sizes, n):
        own = np.maximum(sizes - n + 1, 0)
        start = np.where(own > 0, np.cumsum(sizes) - sizes, 0)
        return start, start + own

    n_words, n_bytes = np.array([len(x) for x in ids]), np.array([len(x) for x in texts])
    two = np.where(word[:-1] == word[1:], np.uint32(1), word[:-1] * np.uint32(0x85EBCA6B) + word[1:])
    three = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16) if len(data) > 2 else data[:0]
    four = three[:-1] | data[3:] << np.uint32(24) if len(data) > 3 else data[:0]
    return Measured(base, [((x * mix) >> shift, *ranges(s, n)) for x, s, n in
                           ((word, n_words, 1), (two, n_words, 2), (three, n_bytes, 3), (four, n_bytes, 4))])


def margins(m: Measured, weights) -> list[float]:
    """Sum over the families of the mean weight of a text's n-grams, and the
    offset (the last weight)."""
    import numpy as np
    z = np.full(len(m.base), weights[-1])
    for f, (place, start, end) in enumerate(m.grams):
        total = np.r_[0.0, np.cumsum(weights[f * DIM:(f + 1) * DIM][place])]
        z += (total[end] - total[start]) / np.maximum(end - start, 1)
    return z


def features(m: Measured) -> list[tuple[list[int], list[float]]]:
    """Places and shares of each text's n-grams, for the fit."""
    import numpy as np
    out = []
    for i in range(len(m.base)):
        at, share = [], []
        for f, (place, start, end) in enumerate(m.grams):
            own, n = np.unique(place[start[i]:end[i]], return_counts=True)
            at.append(own.astype(np.int64) + f * DIM)
            share.append(n / max(1, n.sum()))
        out.append((np.concatenate(at).tolist(), np.concatenate(share).tolist()))
    return out


def fit_weights(rows: list[tuple[list[int], list[float]]], good: list[bool], rounds: int = 40, rate: float = 1.0, pull: float = 1e-6):
    """Weights (the offset last) of the logistic regression by gradient
    descent with a step of its own for each weight; classes weigh the same."""
    import numpy as np
    size = len(FAMILIES) * DIM
    w = np.zeros(size + 1)
    y = np.array(good, float)
    if not len(y) or y.min() == y.max():
        return w
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    of = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    at = np.concatenate([np.array(a, np.int32) for a, _ in rows])
    x = np.concatenate([np.array(s) for _, s in rows])
    seen = np.full(size + 1, 1e-12)
    for _ in range(rounds):
        z = np.bincount(of, x * w[at], len(rows)) + w[-1]
        err = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.r_[np.bincount(at, x * err[of], size), err.sum()] + pull * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def fit_curve(z, good, shares: tuple[float, float], rounds: int = 50) -> tuple[float, float]:
    """a, b of the probability 1 / (1 + exp(-(a z + b))) by Newton steps, on
    Platt's smoothed targets; ``shares`` are those of the bad and the good."""
    import numpy as np
    z, y = np.asarray(z, float), np.asarray(good, bool)
    n = np.array([(~y).sum(), y.sum()], float)
    t = np.where(y, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    each = np.where(y, shares[1] / max(n[1], 1), shares[0] / max(n[0], 1)) * max(1, len(y))
    scale = max(1e-9, float(np.abs(z).max(initial=0)))
    x = np.c_[z / scale, np.ones(len(z))]
    w = np.array([0.0, np.log((shares[1] + 1e-9) / (shares[0] + 1e-9))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (each * (p - t)) + 1e-3 * np.array([w[0], 0.0])
        h = (x * (each * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0) / scale), float(w[1])


class Model(NamedTuple):
    weights: object
    a: float
    b: float

    def score(self, m: Measured) -> list[float]:
        import numpy as np
        return (1 / (1 + np.exp(-np.clip(self.a * margins(m, self.weights) + self.b, -30, 30)))).tolist()


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, text, good of at most ``per_class`` labelled documents a class:
    those of smallest hash of the id."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q")).where("doc_id IS NOT NULL AND q IS NOT NULL")
             .groupBy("doc_id").agg((F.min("q") > 0).alias("good")))
    base = text_of(docs)
    known = known.join(base.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("good").orderBy(*order).limit(per_class).unionByName(known.where("NOT good").orderBy(*order).limit(per_class))
    # at most 2 * per_class ids
    return base.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    import numpy as np

    def run(batches):
        for b in batches:
            ids, good, at = b.column(0).to_pylist(), b.column(1).to_pylist(), 0
            for m in measured(b.column(2).to_pylist()):
                rows = [(ids[at + i], good[at + i], np.array(a, np.int32).tobytes(), np.array(x, np.float32).tobytes())
                        for i, (a, x) in enumerate(features(m))]
                at += len(rows)
                yield rows

    rows = labelled(docs, labels, per_class).select("doc_id", "good", "text")
    # features reach the driver as bytes, not as a Python number each
    got = sorted(map_rows(rows, run, "doc_id long, good boolean, at binary, x binary").collect(), key=lambda r: r["doc_id"])
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    n = known.agg(F.count("*").alias("n"), F.count(F.when(F.col("q") > 0, 1)).alias("good")).first()
    good = [r["good"] for r in got]
    if all(good) or not any(good):
        share = (n["good"] + 1) / (n["n"] + 2)
        return Model(np.zeros(len(FAMILIES) * DIM + 1), 0.0, float(np.log(share / (1 - share))))
    # folds are dealt within each class, in the order of ids
    order, fold = [0, 0], []
    for g in good:
        fold.append(order[g] % FOLDS)
        order[g] += 1
    feats = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32).astype(float)) for r in got]
    fitted = [i for i, f in enumerate(fold) if f or min(order) < FOLDS]
    held = [i for i, f in enumerate(fold) if not f]
    w = fit_weights([feats[i] for i in fitted], [good[i] for i in fitted])
    z = [float(np.dot(w[feats[i][0]], feats[i][1]) + w[-1]) for i in held]
    a, b = fit_curve(z, [good[i] for i in held], (1 - n["good"] / n["n"], n["good"] / n["n"]))
    return Model(w, a, b)


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, keep: float = KEEP,
                  least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score (the calibrated probability of good text)."""
    model = fit(docs, labels, per_class)

    def run(batches):
        for b in batches:
            ids, at = b.column(0).to_pylist(), 0
            for m in measured(b.column(1).to_pylist()):
                rows = []
                for doc, base, p in zip(ids[at:at + len(m.base)], m.base, model.score(m)):
                    failed = base[0] < least_words or 100 * base[4] > most_repeated * base[0]
                    rows.append((doc, *base, failed, not failed and p >= keep, p))
                at += len(rows)
                yield rows

    return map_rows(text_of(docs), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                        "base_failed boolean, kept boolean, score double")


#: The base measures in DuckDB SQL, for tests.
BASE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
t AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM w),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM t),
two AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM two) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
       coalesce(rep.n, 0) AS n_repeat_words,
       len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)
"""
