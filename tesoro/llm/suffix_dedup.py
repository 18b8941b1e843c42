"""Exact substring dedup by a hash-compared, sparse suffix sort.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller doc_id, or the same document further left).  Strings are
judged on the input.

* Anchors.  Every window of ``LENGTH`` bytes names one of its ``GRAM``-byte
  strings, the one with the smallest hash (the leftmost of equals).  Equal
  windows name it at the same place, so windows can only be equal within a
  group of equal anchors.  Neighbouring windows with one anchor form a stretch;
  a document has about one stretch for 35 bytes.
* Grouping.  Stretches are grouped by anchor.  Of stretches equal as a whole
  (by the 64-bit hashes of the stretch and of its anchor) all but the earliest
  go at once.  Anchors with one stretch only are dropped.
* Suffix sort.  Where different stretches share an anchor, their bytes are
  fetched and sorted twice, by the suffix from the anchor and by the reversed
  text before it, in a mergesort that compares two suffixes by prefix
  polynomial hashes and a binary search for their common extension.  Every
  common extension of neighbours is then verified on the bytes; a group whose
  hashes collided is sorted again by bytes.  Neighbours' common extensions give
  the classes of equal windows at each offset; all but the earliest window of
  a class go.
* Hot groups.  Stretches equal within one task's batch are reduced to the
  earliest before the shuffle.  ``GRAM``-byte strings in more than
  ``HOT_SHARE`` of the documents (found on ``HOT_SAMPLE`` documents; at most
  the bytes of a document / ``HOT_SHARE`` of them, so broadcast) become
  anchors only where a window has no other.  So a common line names no group
  of its own: its windows are named by the text beside it, and windows within
  a longer common passage are equal and reduced as above.

Defined results: a null text is empty; rows equal in id and text count as one
document; documents of one id are ordered by a hash of their text, null ids
come last; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import map_rows, row_keys, stage, text_of

LENGTH = 100
GRAM = 32
PIECE = 1 << 19         # window starts handled at once
HOT_SHARE = 0.001       # of the documents
HOT_SAMPLE = 20_000     # documents
_BASE, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_PLACE_BITS = 28


def _mix(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Prefix polynomial hashes of a buffer: the hash of any part of it."""

    _powers: dict[int, tuple] = {}

    def __init__(self, data, base: int = _BASE):
        import numpy as np
        size = len(data)
        known = Prefixes._powers.get(base)
        if known is None or len(known[0]) <= size:
            made = []
            for x in (base, pow(base, -1, 1 << 64)):
                p = np.full(size + 1, np.uint64(x), np.uint64)
                p[0] = 1
                made.append(np.multiply.accumulate(p))
            known = Prefixes._powers[base] = tuple(made)
        self.inverse = known[1]
        letter = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(letter[data] * known[0][:size], out=self.sums[1:])

    def part(self, start, end):
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


class HotGrams:
    """The frequent grams, by their hashes."""

    def __init__(self, hashes):
        import numpy as np
        self.hashes = np.sort(np.asarray(hashes, dtype=np.int64).view(np.uint64))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> np.uint64(44)] = True

    def mask(self, grams):
        import numpy as np
        out = self.seen[grams >> np.uint64(44)]
        if len(self.hashes):
            at = np.nonzero(out)[0]
            near = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
            out[at] = self.hashes[near] == grams[at]
        return out


def stretches(pieces: list[tuple[int, int, bytes]], length: int = LENGTH, gram: int = GRAM, hot: HotGrams | None = None):
    """Stretches of ``pieces`` (document, place in it, bytes), as arrays:
    document, first window, number of windows, anchor's place in the first
    window, anchor hash, stretch hash, and a byte of hash for the text right
    and left of the anchor (0 where the piece ends before).

    A window reaches at least half of the rest to the left or to the right of
    its anchor, so stretches of one anchor share a window only if one of these
    bytes agrees."""
    import numpy as np
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    size = len(data)
    none = np.zeros(0, np.int64)
    nothing = (none,) * 4 + (none.astype(np.uint64),) * 2 + (none,) * 2
    if size < length:
        return nothing
    h = Prefixes(data)
    at = np.arange(size - gram + 1)
    grams = _mix(h.part(at, at + gram))
    # smallest hash first, then leftmost; frequent grams after all others
    key = (grams >> np.uint64(_PLACE_BITS + 1) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    if hot is not None:
        key |= hot.mask(grams).astype(np.uint64) << np.uint64(63)
    wide, n = length - gram + 1, size - length + 1
    width = 1
    while 2 * width <= wide:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    least = np.minimum(key[:n], key[wide - width:wide - width + n])
    anchor = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    ends = np.cumsum([len(p[2]) for p in pieces])
    starts = np.r_[0, ends[:-1]]
    step = np.zeros(size + 1, np.int64)     # windows that would cross an end
    np.add.at(step, np.maximum(starts, ends - length + 1), 1)
    np.add.at(step, ends, -1)
    window = np.nonzero(np.cumsum(step)[:n] == 0)[0]
    if not len(window):
        return nothing
    own = anchor[window]
    first = np.nonzero(np.r_[True, own[1:] != own[:-1]])[0]
    lo, count = window[first], np.diff(np.r_[first, len(window)])
    offset = own[first] - lo
    whole = _mix(h.part(lo, lo + count + length - 1) ^ _mix((offset * 1024 + count).astype(np.uint64)))
    piece = np.searchsorted(ends, lo, "right")
    doc = np.array([p[0] for p in pieces], np.int64)[piece]
    place = np.array([p[1] for p in pieces], np.int64)[piece] + lo - starts[piece]
    half, at = (length - gram) // 2, own[first]

    def beside(start, end):
        inside = (start >= starts[piece]) & (end <= ends[piece])
        start, end = np.where(inside, start, 0), np.where(inside, end, 0)
        return np.where(inside, 1 + (_mix(h.part(start, end)) >> np.uint64(32)) % np.uint64(255), 0).astype(np.int64)

    return (doc, place, count, offset, grams[at], whole, beside(at, at + length - half), beside(at - half - 1, at + gram))


def _pieces(texts, length: int):
    """Groups of (row, place, bytes) of about ``PIECE`` bytes; long texts in
    overlapping parts, so that each window lies in exactly one."""
    group, size = [], 0
    for row, text in enumerate(texts):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(data) - length + 1), PIECE):
            part = data[at:at + PIECE + length - 1]
            if len(part) < length:
                continue
            group.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


#: geo packs the bytes of the text beside the anchor, a stretch's first
#: window, number of windows, anchor place and ``gone``.
_STRETCH = "anchor long, whole long, doc_id long, k1 long, geo long"


def packed_geo(lo, n, off, gone, right=0, left=0):
    import numpy as np
    return (right << 54) | (left << 46) | (lo << 15) | (n.astype(np.int64) << 8) | (off.astype(np.int64) << 1) | gone.astype(np.int64)


def unpacked_geo(geo):
    """lo, n, off, gone, right, left"""
    return (geo >> 15) & 0x7FFFFFFF, (geo >> 8) & 127, (geo >> 1) & 127, (geo & 1).astype(bool), geo >> 54, (geo >> 46) & 255


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc_id, k1, text; whether the ids are unique).  k1 tells rows of one
    id (or of none) apart; it is 0 where the ids are unique, which spares its
    bytes in every shuffle."""
    n = docs.agg(F.count("*").alias("n"), F.count_distinct(F.col("doc_id").cast("long")).alias("d")).first()
    rows = row_keys(text_of(docs)).select("doc_id", "k1", "text")
    unique = n["n"] == n["d"]
    return (rows.withColumn("k1", F.lit(0).cast("long")) if unique else rows), unique


def same_document(a: str, b: str):
    """Join condition on doc_id and k1 (which also tells a null id)."""
    none = F.lit(0).cast("long")
    return (F.coalesce(F.col(f"{a}.doc_id"), none) == F.coalesce(F.col(f"{b}.doc_id"), none)) & (F.col(f"{a}.k1") == F.col(f"{b}.k1"))


def stretch_rows(rows: DataFrame, hot: list[int], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row a stretch; ``gone`` where an equal one stands earlier in the
    same batch (its anchor is then a mere spreading key)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        frequent = HotGrams(hot)
        for b in batches:
            ids = b.column(0)
            order_id = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            k1 = b.column(1).to_numpy(zero_copy_only=False)
            parts = [stretches(group, length, gram, frequent) for group in _pieces(b.column(2), length)]
            if not parts:
                continue
            row, lo, n, off, a, s, right, left = (np.concatenate(x) for x in zip(*parts))
            a, s = a.view(np.int64), s.view(np.int64)
            by = np.lexsort((lo, k1[row], order_id[row], s, a))
            row, lo, n, off, a, s, right, left = (x[by] for x in (row, lo, n, off, a, s, right, left))
            gone = np.r_[False, (a[1:] == a[:-1]) & (s[1:] == s[:-1])] if len(a) else np.zeros(0, bool)
            if gone.any():      # but a repeated row of one document is that document
                twice = gone & np.r_[False, (lo[1:] == lo[:-1]) & (k1[row][1:] == k1[row][:-1]) & (order_id[row][1:] == order_id[row][:-1])]
                row, lo, n, off, a, s, right, left, gone = (x[~twice] for x in (row, lo, n, off, a, s, right, left, gone))
                a, s = np.where(gone, (lo + row * 31) & 0xFFFF, a), np.where(gone, 0, s)
                right, left = np.where(gone, 0, right), np.where(gone, 0, left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(s), ids.take(pa.array(row)), pa.array(k1[row]), pa.array(packed_geo(lo, n, off, gone, right, left))],
                names=["anchor", "whole", "doc_id", "k1", "geo"])

    return rows.mapInArrow(run, _STRETCH)


def hot_grams(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, share: float = HOT_SHARE, sample: int = HOT_SAMPLE) -> list[int]:
    """Hashes of the grams that a sample shows more often than ``share`` of
    its documents.  They only decide how work is dealt out, never what is
    found."""
    total = rows.count()
    every = max(1, total // sample)
    part = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(every)) == 0)

    def frequent(found, kind=None):
        import numpy as np
        key, n = (np.concatenate(x) for x in zip(*found))
        names, of = np.unique(key, return_inverse=True)
        n = np.bincount(of, n, len(names)).astype(np.int64)
        names, n = names[n > 1], n[n > 1]
        return (names if kind is None else names.view(kind)), n

    def run(batches):
        import numpy as np
        for b in batches:
            found: list[tuple] = []
            for group in _pieces(b.column(2), length):
                data = np.frombuffer(b"".join(p[2] for p in group), np.uint8)
                at = np.arange(len(data) - gram + 1)
                found.append(np.unique(_mix(Prefixes(data).part(at, at + gram)), return_counts=True))
                if sum(len(k) for k, _ in found) > 4_000_000:   # bounds the memory; a gram seen once so far is not frequent
                    found = [frequent(found)]
            if found:
                yield [(int(x), int(c)) for x, c in zip(*frequent(found, np.int64))]

    counts = map_rows(part, run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    least = max(20, int(share * min(total, sample)))
    return [r["gram"] for r in counts.where(F.col("n") > least).collect()]


def _carried(batches, key: str):
    """Tables of whole groups of ``key`` from sorted batches."""
    import numpy as np
    import pyarrow as pa
    kept = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if kept is None else pa.concat_tables([kept, t])
        k = t.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield t.slice(0, cut)
        kept = t.slice(cut)
    if kept is not None and kept.num_rows:
        yield kept


def judged_stretches(rows: DataFrame) -> DataFrame:
    """Stretches that go as a whole (``gone``) and, of anchors with several
    different stretches, the earliest ones that may share a window with
    another; all others are dropped."""
    place = [F.col("doc_id").isNull(), "doc_id", "k1", F.col("geo").bitwiseAND(F.lit((1 << 46) - 1))]   # lo leads
    placed = rows.repartition("anchor").sortWithinPartitions("anchor", "whole", *place)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for t in _carried(batches, "anchor"):
            a, s, k1, geo = (t.column(c).to_numpy() for c in ("anchor", "whole", "k1", "geo"))
            ids = t.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            lo, n, off, gone, right, left = unpacked_geo(geo)
            new_a = np.r_[True, a[1:] != a[:-1]]
            new = new_a | np.r_[True, s[1:] != s[:-1]]
            # the same place twice: a document whose row is repeated
            twice = ~new & np.r_[False, (ids[1:] == ids[:-1]) & (k1[1:] == k1[:-1]) & (lo[1:] == lo[:-1])]
            different = np.add.reduceat((new & ~gone).astype(np.int64), np.nonzero(new_a)[0])[np.cumsum(new_a) - 1]
            start = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))   # the earliest equal stretch
            same_place = (ids == ids[start]) & (k1 == k1[start]) & (lo == lo[start])
            gone = gone | ~(new | same_place)
            group = np.cumsum(new_a)
            alike = np.zeros(len(a), bool)
            for side in (right, left):
                own = np.nonzero(new & ~gone & (different > 1) & (side > 0))[0]
                _, of, count = np.unique(group[own] * 256 + side[own], return_inverse=True, return_counts=True)
                alike[own] |= count[of] > 1
            keep = pa.array(~twice & (gone | alike))
            yield pa.RecordBatch.from_arrays(
                [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (
                    c.filter(keep) for c in (t.column("anchor"), t.column("doc_id"), t.column("k1"), pa.array(packed_geo(lo, n, off, gone))))],
                names=["anchor", "doc_id", "k1", "geo"])

    return placed.mapInArrow(run, "anchor long, doc_id long, k1 long, geo long")


class SuffixSort:
    """Sort of many groups of strings at once: a mergesort in which two
    strings are compared by the hash of their prefixes."""

    def __init__(self, strings: list[bytes], group):
        import numpy as np
        self.strings, self.group = strings, np.asarray(group)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings) + b"\0", np.uint8)
        self.hash = Prefixes(self.data)

    def extension(self, x, y):
        """Length of the common prefix by hashes: binary search."""
        import numpy as np
        lo, hi = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        a, b = self.start[x], self.start[y]
        while True:
            go = lo < hi
            if not go.any():
                return lo
            mid = (lo + hi + 1) // 2
            same = self.hash.part(a, a + mid) == self.hash.part(b, b + mid)
            lo, hi = np.where(go & same, mid, lo), np.where(go & ~same, mid - 1, hi)

    def less(self, x, y, ties):
        """Whether string x comes before y; ``ties``: the answer for equals."""
        import numpy as np
        common = self.extension(x, y)
        ended_x, ended_y = common >= self.size[x], common >= self.size[y]
        byte_x = self.data[np.minimum(self.start[x] + common, len(self.data) - 1)]
        byte_y = self.data[np.minimum(self.start[y] + common, len(self.data) - 1)]
        return np.where(ended_x | ended_y, np.where(ended_x & ended_y, ties, ended_x), byte_x < byte_y)

    def sorted(self):
        """(order, common prefix with the string before, -1 at a group's
        start).  Strings of one group are neighbours on entry and stay so."""
        import numpy as np
        n = len(self.strings)
        order = np.arange(n)
        new = np.r_[True, self.group[1:] != self.group[:-1]]
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        stop = np.r_[np.nonzero(new)[0][1:], n][np.cumsum(new) - 1]
        most = int((stop - begin).max(initial=0))
        width = 1
        while width < most:
            at = np.nonzero(stop - begin > width)[0]        # places in groups not yet sorted
            run = (at - begin[at]) // width
            other = begin[at] + (run ^ 1) * width
            lo, hi = np.minimum(other, stop[at]), np.minimum(other + width, stop[at])
            left = run % 2 == 0
            base = lo.copy()
            while True:     # how many of the sibling run come before
                go = np.nonzero(lo < hi)[0]
                if not len(go):
                    break
                mid = (lo[go] + hi[go]) // 2
                # equals of the left run come first
                before = self.less(order[mid], order[at[go]], ~left[go])
                lo[go], hi[go] = np.where(before, mid + 1, lo[go]), np.where(before, hi[go], mid)
            pair = begin[at] + (run // 2) * 2 * width
            place = pair + (at - begin[at]) % width + (lo - base)
            merged = order.copy()
            merged[place] = order[at]
            order = merged
            width *= 2
        common = np.full(n, -1, np.int64)
        inner = np.nonzero(~new)[0]
        if len(inner):
            common[inner] = self.extension(order[inner - 1], order[inner])
            wrong = self._collided(order, common, inner)
            for g in sorted({int(begin[i]) for i in wrong}):   # hashes collided: bytes decide
                end = int(stop[g])
                own = sorted(order[g:end].tolist(), key=lambda i: self.strings[i])
                order[g:end] = own
                for i in range(g + 1, end):
                    x, y = self.strings[own[i - g - 1]], self.strings[own[i - g]]
                    common[i] = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return order, common

    def _collided(self, order, common, inner):
        """Places whose common prefix is not what the bytes say."""
        import numpy as np
        wrong = []
        for at in range(0, len(inner), 20_000):
            i = inner[at:at + 20_000]
            x, y, c = order[i - 1], order[i], common[i]
            k = np.arange(int(c.max(initial=0)) + 1)
            inside = k < c[:, None]
            p = self.data[np.minimum(self.start[x][:, None] + k, len(self.data) - 1)]
            q = self.data[np.minimum(self.start[y][:, None] + k, len(self.data) - 1)]
            bad = (inside & (p != q)).any(axis=1)
            # the bytes after it must differ, or one string ends
            more = (c < self.size[x]) & (c < self.size[y])
            bad |= more & (self.data[np.minimum(self.start[x] + c, len(self.data) - 1)] == self.data[np.minimum(self.start[y] + c, len(self.data) - 1)])
            wrong += i[bad].tolist()
        return wrong


def repeated_windows(group, place, n, off, data: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(row, first window relative to the row's, number) of the windows that
    stand earlier too.  Rows of one anchor are neighbours; ``place`` orders
    rows by the position of their anchors."""
    import numpy as np
    n, off, place = (np.asarray(x, np.int64) for x in (n, off, place))
    count = len(n)
    right = SuffixSort([d[o:] for d, o in zip(data, off.tolist())], group)
    left = SuffixSort([d[:o][::-1] for d, o in zip(data, off.tolist())], group)
    sides = []
    for side in (right, left):
        order, common = side.sorted()
        rank = np.empty(count, np.int64)
        rank[order] = np.arange(count)
        sides.append((common, rank))
    rows, starts = [], []
    for o in range(length - gram + 1):      # windows that begin o bytes before the anchor
        own = np.nonzero((off - n < o) & (o <= off))[0]
        if len(own) < 2:
            continue
        classes = []
        for (common, rank), depth in zip(sides, (length - o, o)):
            first = np.maximum.accumulate(np.where(common < depth, np.arange(count), 0))
            classes.append(first[rank[own]])
        by = np.lexsort((place[own], classes[1], classes[0]))
        same = (classes[0][by][1:] == classes[0][by][:-1]) & (classes[1][by][1:] == classes[1][by][:-1])
        later = own[by][1:][same]
        rows.append(later)
        starts.append(off[later] - o)
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z, z
    row, at = np.concatenate(rows), np.concatenate(starts)
    by = np.lexsort((at, row))
    row, at = row[by], at[by]
    first = np.nonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)])[0] if len(row) else np.zeros(0, np.int64)
    return row[first], at[first], np.diff(np.r_[first, len(row)])


def sorted_groups(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, k1, lo, n: windows of stretches (with their bytes in ``data``)
    that also stand earlier in another stretch of the same anchor."""
    names = ["doc_id", "k1", "lo", "n"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for t in _carried(batches, "anchor"):
            t = t.combine_chunks()
            ids, k1, lo, off = t.column("doc_id"), t.column("k1").to_numpy(), t.column("lo").to_numpy(), t.column("off").to_numpy()
            known = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            place = np.empty(t.num_rows, np.int64)
            place[np.lexsort((lo + off, k1, known, ids.is_null().to_numpy()))] = np.arange(t.num_rows)
            row, at, n = repeated_windows(t.column("anchor").to_numpy(), place, t.column("n").to_numpy(), off,
                                          t.column("data").to_pylist(), length, gram)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)).combine_chunks() if len(row) else pa.array([], pa.int64()), pa.array(k1[row]),
                 pa.array(lo[row] + at), pa.array(n.astype(np.int32))], names=names)

    placed = (rows.select("anchor", "doc_id", "k1", "lo", "n", "off", "data").repartition("anchor").sortWithinPartitions("anchor"))
    return placed.mapInArrow(run, "doc_id long, k1 long, lo long, n int")


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """From :func:`keyed` rows: (texts of documents with repeats: doc_id, k1,
    text and ``own``, an array of (lo, n) windows that go; more windows:
    doc_id, k1, lo, n)."""
    judged = judged_stretches(stretch_rows(rows, hot_grams(rows, length, gram), length, gram))
    gone = F.col("geo").bitwiseAND(F.lit(1)) == 1
    # each of the large shuffles (stretches, texts) belongs to a written step of its own
    by_doc = stage(judged.groupBy("doc_id", "k1").agg(F.collect_list(F.struct(
        F.when(gone, F.lit(0).cast("long")).otherwise(F.col("anchor")).alias("anchor"), "geo")).alias("own")), "suffix-judged")
    held = rows.alias("t").join(by_doc.alias("d"), same_document("t", "d")).select("t.doc_id", "t.k1", "t.text", "d.own")
    held = stage(held, "suffix-texts")
    geo = lambda s: s["geo"]
    lo, n = (lambda s: F.shiftright(geo(s), 15).bitwiseAND(F.lit(0x7FFFFFFF))), (lambda s: F.shiftright(geo(s), 8).bitwiseAND(F.lit(127)).cast("int"))
    asked = (held.select("doc_id", "k1", F.encode("text", "UTF-8").alias("bytes"), F.explode(F.filter("own", lambda s: geo(s).bitwiseAND(F.lit(1)) == 0)).alias("s"))
             .select("doc_id", "k1", "s.anchor", lo(F.col("s")).alias("lo"), n(F.col("s")).alias("n"),
                     F.shiftright("s.geo", 1).bitwiseAND(F.lit(127)).cast("int").alias("off"),
                     F.substring("bytes", lo(F.col("s")).cast("int") + 1, n(F.col("s")) + (length - 1)).alias("data")))
    own = F.transform(F.filter("own", lambda s: geo(s).bitwiseAND(F.lit(1)) == 1), lambda s: F.struct(lo(s).alias("lo"), n(s).alias("n")))
    return held.withColumn("own", own), stage(sorted_groups(asked, length, gram), "suffix-windows")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining
    bytes; null where nothing is removed)."""
    if not 8 <= gram <= length < gram + 127:
        raise ValueError("gram must be 8 to length, and length less than gram + 127")
    texts, unique = keyed(docs)
    held, more = repeated_spans(texts if unique else texts.dropDuplicates(["doc_id", "k1"]), length, gram)
    extra = more.groupBy("doc_id", "k1").agg(F.collect_list(F.struct("lo", "n")).alias("extra"))
    spans = F.when(F.col("e.extra").isNull(), F.col("h.own")).otherwise(F.concat("h.own", "e.extra"))
    rows = (held.alias("h").join(extra.alias("e"), same_document("h", "e"), "left")
            .select("h.doc_id", "h.k1", "h.text", spans.alias("spans")).where(F.size("spans") > 0))

    def cut(batches):
        import hashlib

        import numpy as np
        for b in batches:
            out = []
            for doc, k1, text, spans in zip(*(b.column(i) for i in range(4))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                at = np.sort(np.array([(s["lo"], s["lo"] + s["n"] + length - 1) for s in spans.as_py()], np.int64), axis=0)
                # sorted starts and sorted ends bound the same union
                new = np.r_[True, at[1:, 0] > at[:-1, 1]]
                starts, ends = at[new, 0], at[np.r_[new[1:], True], 1]
                kept = b"".join(data[i:j] for i, j in zip(np.r_[0, ends].tolist(), np.r_[starts, len(data)].tolist()))
                out.append((doc.as_py(), k1.as_py(), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept))
            yield out

    cuts = map_rows(rows, cut, "doc_id long, k1 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    base = texts.select("doc_id", "k1", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return (base.alias("b").join(cuts.alias("c"), same_document("b", "c"), "left")
            .select("b.doc_id", "b.n_bytes", F.coalesce("c.n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("c.n_spans", F.lit(0).cast("long")).alias("n_spans"),
                    F.coalesce("c.kept_sha256", "b.whole").alias("kept_sha256"), "c.kept"))
