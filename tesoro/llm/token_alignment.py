"""Alignment of two tokenizers' tokens over the same texts.

1. Every text is encoded by a byte-level tokenizer (A, of a space and the
   text) and by a sentence-piece model (B, which puts the space before).  Each
   token has a byte end.
2. Galloping intersection of the two lists of ends: the shorter list drives;
   for each of its ends exponential steps through the longer list and a binary
   search between the last two (``gallop``).  Consecutive
   common ends slice the tokens into groups; the differences of their ranks in
   the lists are the ranges of A and B tokens that overlap.
3. Links are the A-B pairs of a group.  An id pair counts the documents that
   hold it linked.  Counts come from one partial aggregate over all documents;
   pairs that are at least 1 in ``HOT`` of all (document, pair) rows, so at
   most ``HOT`` of them, are broadcast, every other pair is joined by key and
   so has at most a share of 1 / ``HOT`` of the rows.

Neither tokenizer's tokens span the place before a space that follows another
character than a space and precedes a letter or digit: A begins a new word
there, and no piece of B holds a space behind another character (checked when
the model is read).  Texts are cut there, and each distinct part is encoded and
intersected once for many texts; a text without such places is one part.

Defined results: texts that are null, empty, or whose joined token bytes
differ from the space and text, have no tokens: zeros and an empty ``groups``;
a row is a document, also if its doc_id repeats or is null; texts of any length
are aligned whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import stage, text_of

#: At most so many id pairs are broadcast.
HOT = 100_000
#: Characters of text aligned together.
GROUP_CHARS = 1_500_000
#: Parts whose ids a task remembers (those it meets first).
KNOWN_PARTS = 250_000
#: Groups with more links are counted by distinct ids.
WIDE_LINKS = 4096
_B_BITS = 20        # an id pair is one long: a * 2^20 + b
_PAIR_BITS = 40


def gallop(x, y, low):
    """For every ``x`` the first place of ``y`` (ascending), from its ``low``
    on, that holds as much: exponential steps, then binary search between the
    last two.  All searches move together as array steps."""
    import numpy as np
    low, high, step, on = low.copy(), low.copy(), 1, np.arange(len(x))
    while len(on):
        on = on[high[on] < len(y)]
        on = on[y[high[on]] < x[on]]
        low[on] = high[on] + 1
        high[on] += step
        step *= 2
    high = np.minimum(high, len(y))
    on = np.nonzero(low < high)[0]
    while len(on):
        middle = (low[on] + high[on]) // 2
        less = y[middle] < x[on]
        low[on[less]] = middle[less] + 1
        high[on[~less]] = middle[~less]
        on = on[low[on] < high[on]]
    return low


def common_ends(a, b, low_a=None, low_b=None):
    """Places (i, j) with ``a[i] == b[j]`` of two ascending arrays; the shorter
    drives.  ``low_a[j]`` is a place in ``a`` that search for ``b[j]`` may
    begin at, and the other way round."""
    import numpy as np
    if len(a) > len(b):
        j, i = common_ends(b, a, low_b, low_a)
        return i, j
    at = gallop(a, b, np.zeros(len(a), np.int64) if low_b is None else low_b)
    i = np.nonzero(at < len(b))[0]
    i = i[b[at[i]] == a[i]]
    return i, at[i]


def byte_level_bytes() -> dict[str, int]:
    """Characters of a byte-level vocabulary -> bytes.  Printable characters
    of Latin-1 stand for themselves, the other bytes in order for 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _flat(start, n):
    """Places ``start[k] .. start[k] + n[k] - 1`` of all k, one after another."""
    import numpy as np
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Aligned(NamedTuple):
    """Counts of texts, their groups as text, and their id pairs: those of
    text k are ``pairs[first[k]:first[k + 1]]``, each with its links."""
    n_a: object
    n_b: object
    n_groups: object
    n_links: object
    groups: list[str]
    first: object
    pairs: object
    times: object


class Aligner:
    """Texts -> token groups of both tokenizers."""

    def __init__(self, file_a: str, file_b: str):
        import os
        import re

        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task keeps to its core
        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True             # their strings in texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        of, vocabulary = byte_level_bytes(), self.a.get_vocab()
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space behind another character")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        # ids as text, followed by what follows them in a group
        self.text_a, self.text_b = (np.array([[f"{i}{c}" for c in "," + last] for i in range(len(own))], object)
                                    for own, last in ((self.bytes_a, "|"), (self.bytes_b, ";")))
        # a space, then everything up to a space behind a non-space before a letter or digit
        self.parts = re.compile(r" [^ ]*(?:(?: (?![^\W_])|(?<=[ ▁]) )[^ ]*)*")
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def _encode(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """(A ids, B ids) as little-endian int32, a part's own."""
        from array import array
        new = [p for p in parts if p not in self.known]
        found_a = self.a.encode_batch_fast(new, add_special_tokens=False)
        found_b = self.b.encode([p[1:] for p in new], num_threads=1)
        own = {p: (array("i", x.ids).tobytes(), array("i", y).tobytes()) for p, x, y in zip(new, found_a, found_b)}
        out = [self.known.get(p) or own[p] for p in parts]
        for p, ids in own.items():
            if len(self.known) >= KNOWN_PARTS:
                break
            if len(p) <= 64:
                self.known[p] = ids
        return out

    def _ids(self, parts: list[str]):
        """Flat A ids and B ids, how many each part has, and which parts'
        token bytes are the part's."""
        import numpy as np
        found = self._encode(parts)
        a, b = (np.frombuffer(b"".join([x[k] for x in found]), np.int32) for k in (0, 1))
        n_a, n_b = (np.fromiter((len(x[k]) // 4 for x in found), np.int64, len(found)) for k in (0, 1))
        join_a, join_b = (b"".join(map(own.__getitem__, ids.tolist())) for own, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        size = np.fromiter((len(p.encode()) for p in parts), np.int64, len(parts))
        stop = np.cumsum(size)
        ends = []
        for ids, n, sizes in ((a, n_a, self.size_a), (b, n_b, self.size_b)):
            total = np.r_[0, np.cumsum(sizes[ids])]
            at = np.cumsum(n)
            ends.append((total[at - n], total[at]))
        if all((e[1] == stop).all() for e in ends) and join_a == join_b == "".join(parts).encode():
            return a, b, n_a, n_b, np.ones(len(parts), bool)
        good = np.array([join_a[x:y] == p.encode() == join_b[u:v]
                         for p, x, y, u, v in zip(parts, ends[0][0].tolist(), ends[0][1].tolist(), ends[1][0].tolist(), ends[1][1].tolist())], bool)
        return a, b, n_a, n_b, good

    def _part_table(self, a, b, n_a, n_b):
        """Of parts whose bytes agree: groups, links and groups as text of
        each, and its links (how many rows, id pairs, times)."""
        from collections import Counter

        import numpy as np
        # one after another the parts are one text; every part's end is common
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        i, j = common_ends(ends_a, ends_b, np.repeat(stop_a - n_a, n_b), np.repeat(stop_b - n_b, n_a))
        from_a, from_b = np.r_[0, i[:-1] + 1], np.r_[0, j[:-1] + 1]
        of_a, of_b = i + 1 - from_a, j + 1 - from_b         # rank differences
        part = np.searchsorted(stop_a, i, "right")
        links = of_a * of_b
        n_groups = np.bincount(part, minlength=len(n_a))
        n_links = np.bincount(part, links, len(n_a)).astype(np.int64)
        # A tokens stand behind the B tokens of earlier groups, B tokens behind the A tokens up to their group
        text = np.empty(len(a) + len(b), object)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[i] = last_b[j] = 1
        text[np.arange(len(a)) + np.repeat(from_b, of_a)] = self.text_a[a, last_a]
        text[np.arange(len(b)) + np.repeat(i + 1, of_b)] = self.text_b[b, last_b]
        cuts = np.r_[0, stop_a + stop_b].tolist()
        text = text.tolist()
        texts = ["".join(text[x:y]) for x, y in zip(cuts, cuts[1:])]
        usual = np.where(links <= WIDE_LINKS, links, 0)
        g = np.repeat(np.arange(len(links)), usual)
        r = np.arange(len(g)) - np.repeat(np.cumsum(usual) - usual, usual)
        pairs = a[from_a[g] + r // of_b[g]].astype(np.int64) << _B_BITS | b[from_b[g] + r % of_b[g]]
        owner, times = part[g], np.ones(len(pairs), np.int64)
        more = [(part[k], x << _B_BITS | y, n * m) for k in np.nonzero(links > WIDE_LINKS)[0].tolist()
                for x, n in Counter(a[from_a[k]:i[k] + 1].tolist()).items() for y, m in Counter(b[from_b[k]:j[k] + 1].tolist()).items()]
        if more:
            extra = np.array(more, np.int64)
            owner, pairs, times = np.r_[owner, extra[:, 0]], np.r_[pairs, extra[:, 1]], np.r_[times, extra[:, 2]]
            order = np.argsort(owner, kind="stable")
            owner, pairs, times = owner[order], pairs[order], times[order]
        return n_groups, n_links, texts, np.bincount(owner, minlength=len(n_a)), pairs, times

    def align(self, texts: list[str]) -> Aligned:
        import numpy as np

        class Numbers(dict):
            def __missing__(self, part):
                self[part] = n = len(self)
                return n

        numbers = Numbers()
        own = [np.fromiter(map(numbers.__getitem__, self.parts.findall(" " + t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        a, b, n_a, n_b, good = self._ids(list(numbers))
        if not good.all():      # the whole text decides; its parts stay in the table for other texts
            doubtful = [k for k, x in enumerate(own) if not good[x].all()]
            w_a, w_b, w_na, w_nb, whole = self._ids([" " + texts[k] for k in doubtful])
            for k, place, fine in zip(doubtful, range(len(numbers), len(numbers) + len(doubtful)), whole.tolist()):
                own[k] = np.array([place] if fine else [], np.int64)
            a, b, n_a, n_b, good = (np.r_[x, y] for x, y in ((a, w_a), (b, w_b), (n_a, w_na), (n_b, w_nb), (good, whole)))
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        n_groups, n_links, part_texts, rows, pairs, times = self._part_table(a, b, n_a, n_b) if len(a) else \
            (n_a, n_a, [""] * len(n_a), n_a, np.zeros(0, np.int64), np.zeros(0, np.int64))
        count = len(texts)
        doc, code = np.repeat(np.arange(count), [len(x) for x in own]), np.concatenate([*own, np.zeros(0, np.int64)])
        sums = [np.bincount(doc, x[code], count).astype(np.int64) for x in (n_a, n_b, n_groups, n_links)]
        groups = ["".join(map(part_texts.__getitem__, x.tolist()))[:-1] for x in own]
        # each text's distinct parts, then the links of those, then its distinct pairs
        both, n = np.unique(doc * (len(n_a) + 1) + code, return_counts=True)
        doc, code = np.divmod(both, len(n_a) + 1)
        size = rows[code]
        at = _flat((np.cumsum(rows) - rows)[code], size)
        both, which = np.unique(np.repeat(doc, size) << _PAIR_BITS | pairs[at], return_inverse=True)
        total = np.bincount(which, times[at] * np.repeat(n, size), len(both)).astype(np.int64)
        first = np.searchsorted(both, np.arange(count + 1) << _PAIR_BITS)
        return Aligned(*sums, groups, first, both & (1 << _PAIR_BITS) - 1, total)


def _aligned(docs: DataFrame, file_a: str, file_b: str, columns, ddl: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and ``columns(aligned, types)``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {ddl}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        aligner = Aligner(file_a, file_b)
        for b in batches:
            ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
            at = 0
            while at < b.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_CHARS, "right")))
                found = aligner.align(b.column(1).slice(at, stop - at).to_pylist())
                values = [b.column(0).slice(at, stop - at), *map(pa.array, found[:4]), *columns(found, schema.types[5:])]
                yield pa.RecordBatch.from_arrays(values, schema=schema)
                at = stop

    return text_of(docs).mapInArrow(run, ddl)


def token_groups(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``)."""
    def columns(found, types):
        import pyarrow as pa
        return [pa.array(found.groups, types[0])]

    return _aligned(docs, file_a, file_b, columns, "groups string")


def _aligned_rows(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """As ``token_groups`` with the digest of groups, and the document's id
    pairs with how many of its links each holds."""
    def columns(found, types):
        from hashlib import sha256

        import pyarrow as pa
        digests = [sha256(g.encode()).hexdigest() if n else "" for g, n in zip(found.groups, found.n_a.tolist())]
        first = pa.array(found.first, pa.int32())
        return [pa.array(digests, types[0]), *(pa.ListArray.from_arrays(first, pa.array(x), type=t) for x, t in zip((found.pairs, found.times), types[1:]))]

    return _aligned(docs, file_a, file_b, columns, "groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (the highest n of
    its a) of links (pair, one row a document)."""
    n = stage(links.groupBy("pair").agg(F.count("*").alias("n")), "align-pairs")
    a = F.shiftright("pair", _B_BITS)
    highest = n.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))      # at most one row an id of A
    return n.withColumn("a", a).join(highest, "a").select("pair", "a", F.pmod("pair", F.lit(1 << _B_BITS)).alias("b"), "n",
                                                          (F.col("n") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, file_a: str, file_b: str, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose id pair has
    the highest count of its A id), count_sum (over links), groups_sha256."""
    rows = stage(_aligned_rows(docs, file_a, file_b).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts = stage(pair_counts(links).select("pair", "n", "best"), "align-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = F.col("n") * hot >= F.lit(total)
    known = F.broadcast(counts.where(often))        # at most ``hot`` rows, as the n add up to the total
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    found = links.join(known, "pair").groupBy("row").agg(*sums)
    rest = links.join(known.select("pair"), "pair", "left_anti").join(counts.where(~often), "pair").groupBy("row").agg(*sums)
    both = found.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs", "times").join(both, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
