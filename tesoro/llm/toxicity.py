"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a
block-max inverted index, distance-weighted votes, calibrated scores.

* Examples: at most ``PER_CLASS`` labelled texts a class (a documented bound),
  those with the smallest hash of their id; equal texts count once.
* Weights: (1 + log tf) * idf for every word of a text, with document
  frequencies counted over the whole corpus.  Words in at most one of ``RARE``
  documents share the idf of that share, so only the more frequent ones need a
  table: at most ``RARE`` times the mean number of distinct words a document.
  Words whose presence tells the classes apart among the examples (likelihood
  ratio) weigh more; none is left out.
* Index: postings of every word of the examples, cut into blocks of ``BLOCK``
  examples with the largest weight a word has in each.  A text first visits
  the blocks with the highest bounds, then every block whose bound reaches its
  k-th cosine so far, so the k nearest are exact.  Words of more than one of
  ``DENSE`` examples have full rows of postings (at most ``DENSE`` times the
  mean number of words an example) that a batch of texts meets at once.  Norms
  run over all words of a text, those that no example holds included.
* Score: the neighbours' labels, weighted by 1 / (0.05 + distance), calibrated
  by a logistic fit to leave-one-out votes of the examples and set right for
  the class shares of all labelled rows.  A text that shares no word with any
  example gets the share of toxic texts among examples without words and one
  clean one more.

Labels, language, source and id of a scored text are never inputs of its
score.

Defined results: a null text is empty; every row is scored, repeated ones and
null ids too (a null id is not held out); without labelled rows of both
classes every score is the share of toxic rows (0 if none); several labels of
one id count as toxic if one does; a very long text is one vector of its
distinct words; equal cosines go to the example earlier in the index; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import ascii_words, map_rows, stage, text_of

PER_CLASS = 2000
#: Words in at most one of so many documents weigh alike.
RARE = 1000
#: Weight of the label test: sqrt of the likelihood ratio beyond chance.
LABEL_WEIGHT = 1.0
CHANCE = 3.0
NEIGHBOURS = 15
BLOCK = 32
#: Blocks visited before bounds are compared with the k-th cosine.
FIRST = 4
#: A word in more than one of so many examples has its postings as a full row.
DENSE = 16
#: Texts searched together.
BATCH = 250
#: Words a task counts before it passes them on.
FLUSH = 200_000


def examples(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of the examples and the rows of each class among
    all labelled documents."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("label"))
             .join(text_of(docs).select("doc_id").distinct(), "doc_id"))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * per_class ids: broadcast
    found = (text_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.min(F.struct("doc_id", "label")).alias("r"))
             .select("r.doc_id", "text", "r.label").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")))
    return stage(found, "toxicity-examples"), shares


def _term_rows(found: DataFrame) -> DataFrame:
    def count(batches):
        from collections import Counter
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                yield [(doc, w, n) for w, n in Counter(ascii_words(text.as_py())).items()]
    return map_rows(found.select("doc_id", "text"), count, "doc_id long, term binary, n int")


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): the documents of the corpus that hold each word; the empty
    term counts all documents."""
    def count(batches):
        from collections import Counter
        n: Counter = Counter()
        for b in batches:
            n[b""] += b.num_rows
            for text in b.column(0):
                n.update(set(ascii_words(text.as_py())))
                if len(n) >= FLUSH:
                    yield list(n.items())
                    n = Counter()
        yield list(n.items())

    return map_rows(text_of(docs).select("text"), count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))


def label_weights(a, b, n0: int, n1: int):
    """Weight of each word from the examples of the classes that hold it
    (``a``, ``b`` of ``n0``, ``n1``): 1 for a word that tells nothing."""
    import numpy as np
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    if not n0 or not n1:
        return np.ones(len(a))
    share = (a + b) / (n0 + n1)
    g2 = np.zeros(len(a))
    for seen, expected in ((a, n0 * share), (b, n1 * share), (n0 - a, n0 * (1 - share)), (n1 - b, n1 * (1 - share))):
        g2 += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))
    return 1 + LABEL_WEIGHT * np.maximum(0, np.sqrt(np.maximum(g2, 0)) - CHANCE)


def _ranges(start, length):
    """The numbers of all ranges, one after the other."""
    import numpy as np
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


class Examples:
    """Block-max inverted index over the examples' unit vectors.

    ``total`` documents, ``held`` the documents of each word that stands in
    more than one of ``rare`` of them; ``counts`` the words of each example."""

    def __init__(self, counts, labels, ids, held: dict[bytes, int], total: int, shares: dict[int, int],
                 k: int = NEIGHBOURS, rare: int = RARE):
        import numpy as np
        self.k = k
        from collections import Counter
        holders = Counter(t for c in counts for t in c)
        own = sorted(holders, key=lambda t: (holders[t] * DENSE <= len(counts), t))
        self.common = sum(1 for n in holders.values() if n * DENSE > len(counts))   # the first columns
        other = sorted(held.keys() - set(own))
        self.own = len(own)
        self.column = {t: i for i, t in enumerate(own + other)}
        least = total / rare
        seen = np.array([held.get(t, 0) for t in own + other] + [0], dtype=float)   # the last: any other word
        idf = np.log1p(total / np.maximum(np.maximum(seen, least), 1e-9)) if total else np.ones(len(seen))
        n = [labels.count(0), labels.count(1)]
        holds = np.zeros((2, self.own))
        for c, label in zip(counts, labels):
            holds[label, [self.column[t] for t in c]] += 1
        self.idf = idf
        self.telling = label_weights(*holds, *n)
        self.idf[:self.own] *= self.telling
        self.strong = {t: float(w) for t, w in zip(own, self.telling) if w > 1}
        vectors = [self.vector(c) for c in counts]
        # examples with the same heaviest word share blocks: tighter bounds
        filled = [i for i, (cols, _) in enumerate(vectors) if len(cols)] if min(n) else []
        heaviest = {i: int(vectors[i][0][vectors[i][1].argmax()]) for i in filled}
        order = sorted(filled, key=lambda i: (heaviest[i], ids[i]))
        self.label = np.array([labels[i] for i in order], dtype=float)
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self._index([vectors[i] for i in order])
        self._calibrate(labels, [vectors[i] for i in order], len(order), n, shares)

    def _index(self, vectors):
        import numpy as np
        empty = [np.zeros(0)]
        cols = np.concatenate([c for c, _ in vectors] or empty).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or empty)
        rows = np.repeat(np.arange(len(vectors)), [len(c) for c, _ in vectors])
        at = np.lexsort((rows, cols))
        cols, rows, weight = cols[at], rows[at], weight[at]
        self.blocks = -(-len(vectors) // BLOCK)
        often = cols < self.common
        full = np.zeros((self.common, self.blocks * BLOCK))
        full[cols[often], rows[often]] = weight[often]
        self.full, self.full_most = full[:, :len(vectors)].copy(), full.reshape(self.common, self.blocks, BLOCK).max(axis=2)
        cols, self.rows, self.weight = cols[~often], rows[~often], weight[~often]
        self.block = self.rows // BLOCK
        first = np.ones(len(cols), bool)
        first[1:] = (cols[1:] != cols[:-1]) | (self.block[1:] != self.block[:-1])
        begin = np.nonzero(first)[0]
        self.most = np.zeros(len(cols))     # largest weight of a word in a block, at its first posting there
        self.most[begin] = np.maximum.reduceat(self.weight, begin) if len(begin) else 0
        self.begin = np.searchsorted(cols, np.arange(self.own + 1))   # postings of a word

    def vector(self, counts):
        """(columns, weights) of the words the index knows; the text's norm
        over all its words is 1."""
        import numpy as np
        get, other = self.column.get, len(self.idf) - 1
        cols = np.array([get(t, other) for t in counts], dtype=np.int64)
        x = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * self.idf[cols]
        norm = math.sqrt(float(np.sort(x * x).sum()))
        keep = cols < self.own
        return cols[keep], x[keep] / (norm or 1.0)

    def _cosines(self, at, q, take):
        """Shares of rarer words in the cosines, from the postings to take."""
        import numpy as np
        at, q = at[take], q[take]
        return np.bincount(self.rows[at], q * self.weight[at], len(self.ids))

    def _nearest(self, cols, q, s, bound, skip):
        """The k nearest of one text; ``s`` and ``bound`` hold the shares of
        common words.  Weights are positive, so cosines only grow: the k-th
        value at any moment is at most the k-th cosine."""
        import numpy as np
        length = self.begin[cols + 1] - self.begin[cols]
        at, q = _ranges(self.begin[cols], length), np.repeat(q, length)
        block = self.block[at]
        bound = bound + np.bincount(block, q * self.most[at], self.blocks) + 1e-8
        first = np.zeros(self.blocks, bool)
        first[np.argpartition(-bound, FIRST - 1)[:FIRST] if self.blocks > FIRST else slice(None)] = True
        s = s + self._cosines(at, q, first[block])
        if skip >= 0:
            s[skip] = 0
        kth = np.partition(s, -self.k)[-self.k] if len(s) >= self.k else 0.0
        rest = (bound >= kth) & ~first
        if rest.any():
            s += self._cosines(at, q, rest[block])
            if skip >= 0:
                s[skip] = 0
        s = np.round(s, 9)
        kth = np.partition(s, -self.k)[-self.k] if len(s) >= self.k else 0.0
        found = np.nonzero((s >= kth) & (s > 0))[0]
        found = found[np.argsort(-s[found], kind="stable")][:self.k]
        return s[found], found

    def nearest(self, vectors, skip=None):
        """(cosines, example rows) of the k nearest of each vector, best first;
        cosine 0 and row -1 where there are fewer.  ``skip``: the example each
        text is itself."""
        import numpy as np
        sims, rows = np.zeros((len(vectors), self.k)), np.full((len(vectors), self.k), -1)
        for at in range(0, len(vectors), BATCH) if self.blocks else ():
            part = vectors[at:at + BATCH]
            q = np.zeros((len(part), self.common))
            for i, (cols, w) in enumerate(part):
                often = cols < self.common
                q[i, cols[often]] = w[often]
            shares, bounds = q @ self.full, q @ self.full_most
            for i, (cols, w) in enumerate(part):
                rare = cols >= self.common
                found, r = self._nearest(cols[rare], w[rare], shares[i], bounds[i], -1 if skip is None else skip[at + i])
                sims[at + i, :len(r)], rows[at + i, :len(r)] = found, r
        return sims, rows

    def votes(self, sims, rows):
        import numpy as np
        w = np.where(rows >= 0, 1 / (0.05 + np.sqrt(np.maximum(0, 2 - 2 * sims))), 0.0)
        total = w.sum(axis=1)
        toxic = (w * self.label[np.maximum(rows, 0)]).sum(axis=1) if len(self.label) else total * 0
        return np.where(total > 0, toxic / np.where(total > 0, total, 1), np.nan)

    def _calibrate(self, labels, vectors, filled, n, shares):
        import numpy as np
        all_rows = max(1, shares.get(0, 0) + shares.get(1, 0))
        weight = {c: shares.get(c, 0) / all_rows / max(1, n[c]) for c in (0, 1)}
        bare = [n[c] - int((self.label == c).sum()) for c in (0, 1)]
        odds = [weight[c] * bare[c] for c in (0, 1)]
        # one clean example without known words is taken for granted
        self.bare = odds[1] / (sum(odds) + weight[0]) if min(n) else shares.get(1, 0) / all_rows
        self.a, self.b = 6.0, -3.0
        if filled:
            v = self.votes(*self.nearest(vectors, range(filled)))
            ok = ~np.isnan(v)
            x = np.stack([v[ok], np.ones(ok.sum())], 1)
            y, w = self.label[ok], np.array([weight[int(c)] for c in self.label[ok]])
            w = w / max(w.sum(), 1e-12) * len(w)
            # targets a little inside 0 and 1, a weak pull to the start values
            start = np.array([self.a, self.b])
            beta = start.copy()
            for _ in range(50):
                p = 1 / (1 + np.exp(-(x @ beta)))
                grad = x.T @ (w * (p - (0.98 * y + 0.01))) + 0.05 * (beta - start)
                hess = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
                step = np.linalg.solve(hess, grad)
                beta = beta - step
                if abs(step).max() < 1e-9:
                    break
            self.a, self.b = (float(z) for z in beta)

    def score(self, counts):
        """(score, ids of the nearest examples) of each text's word counts."""
        import numpy as np
        sims, rows = self.nearest([self.vector(c) for c in counts])
        v = self.votes(sims, rows)
        scores = np.where(np.isnan(v), self.bare, 1 / (1 + np.exp(-(self.a * np.nan_to_num(v) + self.b))))
        return scores, [[int(self.ids[x]) for x in r[:3] if x >= 0] for r in rows]

    def tells(self, counts) -> list[bytes]:
        """A text's words that weigh more for their labels, strongest first."""
        return sorted(self.strong.keys() & counts.keys(), key=lambda t: (-self.strong[t], t))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS, rare: int = RARE) -> Examples:
    """Index and calibration from labelled rows; corpus counts from all docs.
    What reaches the driver is the words of at most ``2 * per_class`` texts and
    the words in more than one of ``rare`` documents."""
    found, shares = examples(docs, labels, per_class)
    ids = sorted((r["doc_id"], r["label"]) for r in found.select("doc_id", "label").collect())
    place = {doc: i for i, (doc, _) in enumerate(ids)}
    counts: list[dict[bytes, int]] = [{} for _ in ids]
    rows = _term_rows(found).toArrow()
    term = rows["term"].combine_chunks().dictionary_encode()
    own = term.dictionary.to_pylist()       # one object a word, however many examples hold it
    for at in range(0, rows.num_rows, FLUSH // 4):
        part = rows.slice(at, FLUSH // 4)
        for doc, i, n in zip(part["doc_id"].to_pylist(), term.indices.slice(at, FLUSH // 4).to_pylist(), part["n"].to_pylist()):
            counts[place[doc]][own[i]] = n
    del rows, term
    words = stage(document_frequencies(docs), "toxicity-words")
    total = sum(r["n"] for r in words.where(F.col("term") == F.lit(bytearray())).collect())
    often = words.where((F.col("n") * rare > total) & (F.length("term") > 0)).toArrow()
    held = dict(zip(often["term"].to_pylist(), often["n"].to_pylist()))
    return Examples(counts, [label for _, label in ids], [doc for doc, _ in ids], held, total, shares, k, rare)


def word_counts(column) -> list:
    from collections import Counter
    return [Counter(ascii_words(text.as_py() or "")) for text in column]


def score(docs: DataFrame, model: Examples) -> DataFrame:
    """doc_id, score, predicted, evidence (ids of the nearest examples) and
    terms (the text's words that tell the classes apart)."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                counts = word_counts(part.column(1))
                scores, near = model.score(counts)
                yield [(d, float(s), int(s >= 0.5), e, [t.decode("utf-8", "replace") for t in model.tells(c)])
                       for d, s, e, c in zip(part.column(0).to_pylist(), scores, near, counts)]
    return map_rows(text_of(docs), run, "doc_id long, score double, predicted int, evidence array<long>, terms array<string>")


def keep_civil(docs: DataFrame, model: Examples) -> DataFrame:
    """The documents not predicted toxic, all columns as they are."""
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                yield part.filter(pa.array(model.score(word_counts(part.column(at)))[0] < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id="doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence, terms; learnt from the
    labelled rows that are not held out."""
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence", "terms")
