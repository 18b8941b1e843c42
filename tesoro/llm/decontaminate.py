"""Benchmark decontamination by the q-gram lemma.

Texts are reduced to their words (A-Z in lower case, ASCII signs dropped, one
space between words).  A passage within ``budget`` edits of an item of m
characters shares at least ``m - q + 1 - q * budget`` of the item's q-grams
with it, and all of them lie on neighbouring diagonals (place in the text
minus place in the item).  So:

* every place of a text is looked up in the items' q-gram table;
* hits are counted per item in diagonal bands that overlap by half, wide
  enough that any passage within the budget has all its hits in one of them;
* bands that reach the bound are kept and verified by a banded alignment of
  the item with that region.

The items are sent to the tasks in blocks of at most ``BLOCK_CHARS``
characters, so the data broadcast at once is bounded however many items there
are.  The texts never leave their task.

Edit budget: ``rate`` of the item's length, lowered for short items until the
bound is positive.  Items with fewer than q characters have no q-gram; they
match where exactly their words stand next to each other (their places are
found by a table of such items, looked up at every word of a text).

Defined results: null texts match nothing; items without a word match
nothing; null and repeated ids are reported row by row; several matches of one
item in one text give the best one (fewest edits, then the first place); a very
long text is looked up place by place within its task; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import ascii_words, map_rows, text_of

Q = 12
RATE = 0.05
BLOCK_CHARS = 4_000_000


def reduced(text: str | None) -> bytes:
    return b" ".join(ascii_words(text or ""))


def budget(m: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed for an item of m characters; at least one shared q-gram
    must follow from them."""
    return max(0, min(int(rate * m), (m - q) // q))


def banded_alignment(item: bytes, text: bytes, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Best (edits, start, end) of ``item`` in ``text`` with at most ``most``
    edits, its path within the diagonals low..high."""
    import numpy as np
    n, far = len(text), 1 << 20
    diagonals = np.arange(low, high + 1)
    # cost[k]: item[:i] against text ending at i + diagonals[k]; from: where that path starts
    cost = np.where((diagonals >= 0) & (diagonals <= n), 0, far)
    start = diagonals.copy()
    chars = np.frombuffer(text, np.uint8)
    for i, c in enumerate(item, 1):
        ends = i + diagonals
        inside = (ends >= 1) & (ends <= n)
        same = np.zeros(len(diagonals), bool)
        same[inside] = chars[ends[inside] - 1] == c
        step = np.where(inside, cost + ~same, far)                     # match or replace
        skip = np.r_[cost[1:] + 1, far]                                # item character left out
        better = skip < step
        new = np.where(better, skip, step)
        first = np.where(better, np.r_[start[1:], 0], start)
        new[(ends < 0) | (ends > n)] = far
        # text character added: cost grows by one for each step to the right
        k = np.arange(len(new))
        low_at = np.minimum.accumulate((new - k) * len(new) + k)       # carries the place of the minimum
        src = low_at % len(new)
        cost, start = new[src] + k - src, first[src]
        cost[(ends < 0) | (ends > n)] = far
        if cost.min() > most:
            return None
    best = int(cost.min())
    if best > most:
        return None
    k = int(np.nonzero(cost == best)[0][0])
    return best, int(start[k]), int(len(item) + diagonals[k])


class GramTable:
    """The q-grams of a block of items, looked up for all places of a text."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, rate: float = RATE):
        import numpy as np
        self.q = q
        self.items = [(i, t, budget(len(t), q, rate)) for i, t in items if len(t) >= q]
        codes, owner, place = [], [], []
        for k, (_, t, _) in enumerate(self.items):
            h = self.codes(t)
            codes.append(h)
            owner.append(np.full(len(h), k, np.int64))
            place.append(np.arange(len(h)))
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        codes, owner, place = cat(codes, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(codes, kind="stable")
        self.code, self.owner, self.place = codes[order], owner[order], place[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.code >> np.uint64(42)] = True
        self.width = np.array([e + 1 for *_, e in self.items], np.int64)
        self.need = np.array([len(t) - q + 1 - q * e for _, t, e in self.items], np.int64)
        self.short: dict[bytes, list[int]] = {}     # items without a q-gram
        for i, t in items:
            if 0 < len(t) < q:
                self.short.setdefault(t, []).append(i)
        self.lengths = sorted({t.count(b" ") + 1 for t in self.short})

    def codes(self, text: bytes):
        """A 64-bit code of the q-gram at every place."""
        import numpy as np
        n = len(text) - self.q + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        head = np.ndarray((n,), "<u8", text, 0, (1,))
        h = head * np.uint64(0x9E3779B97F4A7C15)
        for at in [*range(8, self.q - 7, 8), *([self.q - 8] if self.q % 8 else [])]:
            h = (h ^ (h >> np.uint64(29)) ^ np.ndarray((n,), "<u8", text, at, (1,))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(31))

    def matches(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits), one row an item."""
        return self._near(text) + (self._short(text) if self.short else [])

    def _short(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """The first place of each short item, word by word."""
        words, found, start = text.split(), {}, 0
        for i, w in enumerate(words):
            for n in self.lengths:
                if i + n > len(words):
                    break
                piece = b" ".join(words[i:i + n]) if n > 1 else w
                if piece in self.short and piece not in found:
                    found[piece] = start
            start += len(w) + 1
        return [(i, at, at + len(t), 0) for t, at in sorted(found.items()) for i in self.short[t]]

    def _near(self, text: bytes) -> list[tuple[int, int, int, int]]:
        import numpy as np
        if not self.items:
            return []
        h = self.codes(text)
        at = np.nonzero(self.seen[h >> np.uint64(42)])[0]
        if not len(at):
            return []
        lo, hi = np.searchsorted(self.code, h[at], "left"), np.searchsorted(self.code, h[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            return []
        hit = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        owner, shift = self.owner[hit], np.repeat(at, n) - self.place[hit]
        # a band is two widths of e + 1 diagonals; each hit counts in both bands over it
        band = (shift + (1 << 40)) // self.width[owner]
        keys, counts = np.unique(np.concatenate([owner << 44 | band, owner << 44 | band - 1]), return_counts=True)
        kept = keys[counts >= self.need[keys >> 44]]
        best: dict[int, tuple[int, int, int]] = {}
        for key in kept.tolist():
            k = key >> 44
            item_id, item, e = self.items[k]
            if k in best and best[k][0] == 0:
                continue
            low = (key & ((1 << 44) - 1)) * (e + 1) - (1 << 40)
            left = max(0, low - e)
            region = text[left:low + 2 * (e + 1) + len(item) + e]
            exact = region.find(item)
            found = (0, exact, exact + len(item)) if exact >= 0 else \
                banded_alignment(item, region, low - left - e, low - left + 2 * e + 2 + e, e)
            if found:
                found = (found[0], found[1] + left, found[2] + left)
                if k not in best or found < best[k]:
                    best[k] = found
        return [(self.items[k][0], s, t, e) for k, (e, s, t) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[list[tuple[int, bytes]]]:
    """The items in blocks of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    blocks = 1 + total // block_chars
    return [[(r["item_id"], reduced(r["text"])) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()]
            for i in range(blocks)]


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, first_word, n_words, edits, similarity: the passages
    of documents within the edit budget of a benchmark item."""
    out = None
    for items in item_blocks(benchmark):
        def scan(batches, items=items):
            table = GramTable(items, q, rate)
            size = {i: len(t) for i, t in items}
            for b in batches:
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    t = reduced(text.as_py())
                    for item, start, end, edits in table.matches(t):
                        rows.append((doc, item, t.count(b" ", 0, start), len(t[start:end].split()), edits, 1 - edits / size[item]))
                yield rows
        part = map_rows(text_of(docs), scan, "doc_id long, item_id long, first_word long, n_words long, edits int, similarity double")
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """The documents without any such passage, all columns as they are."""
    at = docs.columns.index("text")
    for items in item_blocks(benchmark):
        def clean(batches, items=items):
            import pyarrow as pa
            table = GramTable(items, q, rate)
            for b in batches:
                yield b.filter(pa.array([not table.matches(reduced(t.as_py())) for t in b.column(at)], pa.bool_()))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
