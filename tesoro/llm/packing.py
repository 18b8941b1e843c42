"""Best-fit packing of tokenised documents into fixed-length sequences.

Method (large-item matching): pieces longer than a third of the capacity sit
at most two to a sequence; they are matched greedily, the longest with the
longest partner that still fits.  Shorter pieces then go, longest first, to
the sequence with the smallest gap that holds them (best fit).

The plan needs only how many pieces have each length: at most ``capacity``
counters, whatever the corpus.  It is computed on the driver from those
counters as segments "pieces of length L with rank r .. r+n-1 go to sequences
s .. s+n-1 at offset o".  Every step of the plan uses up a length class or a
gap class, so the number of segments is bounded by the capacity squared and in
practice by a few thousand; that table is broadcast.  The ranks are numbered
in slices of a length class, so a length shared by all pieces is still many
tasks.

Defined results: a null text is an empty document (one end id); a row is one
document, also if its doc_id repeats or is null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesoro.llm.common import map_rows, stage, text_of

CAPACITY = 2048
#: Rows numbered together when pieces of one length get their ranks.
SLICE_ROWS = 500
#: Bytes of text encoded together.
GROUP_CHARS = 16_000_000


def encoder(tokenizer_file: str):
    """Arrow array of texts -> (all ids as uint32, where each text's ids
    begin), as the tokenizer gives for each whole text.

    No token spans a space or a line feed (white space is dropped before the
    merges), so the texts are split there by Arrow and only distinct words are
    encoded.  Those of plain letters, perhaps with signs behind, are encoded
    together, one call for many; a token that ends a word is marked in the
    vocabulary, which parts the result."""
    import operator
    import os
    import re

    import numpy as np
    import pyarrow.compute as pc
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task keeps to its core
    tok = Tokenizer.from_file(tokenizer_file)
    vocabulary = tok.get_vocab()
    ends_word = np.zeros(1 + max(vocabulary.values()), bool)
    ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    # every word is one line: letters and then signs, or anything else
    parts = re.compile("^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,:;!?$*&%#|]*)|([^\\n]*))$", re.MULTILINE)

    def ids(s: str) -> bytes:
        return np.asarray(tok.encode(s, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(words: list[str]) -> dict[str, bytes]:
        """Ids of lower-case words of plain letters, encoded together."""
        out = {"": b""}
        groups = [words[at:at + 1000] for at in range(0, len(words), 1000)]
        for own, encoding in zip(groups, tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            found = np.asarray(encoding.ids, "<u4")
            cuts = np.r_[0, np.nonzero(ends_word[found])[0] + 1]
            if len(cuts) != len(own) + 1 or cuts[-1] != len(found):
                out.update((w, ids(w)) for w in own)
                continue
            data, cuts = found.tobytes(), (cuts * 4).tolist()
            out.update(zip(own, (data[i:j] for i, j in zip(cuts, cuts[1:]))))
        return out

    def encode(texts):
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        names = words.dictionary.to_pylist()
        cut = parts.findall("\n".join(names)) if names else []
        cores = "\n".join([x[0] for x in cut]).lower().split("\n") if cut else []
        signs = [x[1] for x in cut]
        core_ids, sign_ids = plain(list(set(cores).difference([""]))), {x: ids(x) if x else b"" for x in set(signs)}
        found = list(map(operator.add, map(core_ids.__getitem__, cores), map(sign_ids.__getitem__, signs)))
        for i, x in enumerate(cut):
            if x[2]:
                found[i] = ids(x[2])
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        start, data = np.cumsum(size) - size, np.frombuffer(b"".join(found), "<u4")
        at = words.indices.to_numpy()
        each = size[at]
        ends = np.cumsum(each, dtype=np.int64)
        begins = np.r_[0, ends][lists.offsets.to_numpy()]
        flat = np.empty(begins[-1], "<u4")
        for i in range(0, len(at), 1 << 18):    # a stretch of words at a time bounds the index arrays
            n, stop = each[i:i + (1 << 18)], ends[i:i + (1 << 18)]
            first = stop[0] - n[0]
            flat[first:stop[-1]] = data[np.repeat(start[at[i:i + (1 << 18)]] - (stop - n - first), n) + np.arange(stop[-1] - first)]
        return flat, begins

    return encode


def tokenized_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and an end
    id, cut only where longer than ``capacity``."""
    def groups(column):
        """Row ranges of about ``GROUP_CHARS`` bytes of text."""
        import numpy as np
        import pyarrow.compute as pc
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + GROUP_CHARS, "right")))
            yield first, stop
            first = stop

    def run(batches):
        encode = encoder(tokenizer_file)
        end = int(end_id).to_bytes(4, "little")
        for b in batches:
            rows, doc_ids = [], b.column(0).to_pylist()
            for first, stop in groups(b.column(1)):
                flat, begins = encode(b.column(1).slice(first, stop - first))
                for doc, x, y in zip(doc_ids[first:stop], begins.tolist(), begins[1:].tolist()):
                    ids = flat[x:y].tobytes() + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at:at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            yield rows

    return map_rows(text_of(docs), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first rank, n, first sequence, offset)."""
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)     # ranks given out per length
    gaps: dict[int, list[list[int]]] = defaultdict(list)  # gap -> [first sequence, n]
    segments: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        segments.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def opened(n: int) -> int:
        nonlocal sequences
        sequences += n
        return sequences - n

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        for partner in (p for p in large if p <= min(length, capacity - length)):
            n = left[length] // 2 if partner == length else min(left[length], left[partner])
            if n > 0:
                first = opened(n)
                put(length, n, first, 0)
                put(partner, n, first, length)
                gaps[capacity - length - partner].append([first, n])
            if left[length] == 0:
                break
        if left[length]:
            n = left[length]
            first = opened(n)
            put(length, n, first, 0)
            gaps[capacity - length].append([first, n])
    for length in sorted((n for n in left if 3 * n <= capacity and left[n]), reverse=True):
        while left[length]:
            fits = [g for g, own in gaps.items() if g >= length and own]
            if fits:
                gap = min(fits)
                first, n = gaps[gap].pop()
                take = min(n, left[length])
                if take < n:
                    gaps[gap].append([first + take, n - take])
            else:
                gap, take = capacity, -(-left[length] // (capacity // length))
                first = opened(take)
            put(length, take, first, capacity - gap)
            if gap > length:
                gaps[gap - length].append([first, take])
    return segments


def pack(pieces: DataFrame, capacity: int = CAPACITY, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (doc_id, piece,
    length and anything else); no sequence exceeds ``capacity``."""
    spark = pieces.sparkSession
    pieces = stage(pieces, "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # a length that many pieces share is numbered in as many slices as it needs
    slices = spark.createDataFrame([(n, 1 + c // slice_rows) for n, c in counts.items()], "length long, _slices long")
    segments = plan(counts, capacity)
    table = F.broadcast(spark.createDataFrame(segments, "length long, rank0 long, n long, seq0 long, offset long"))
    sliced = (pieces.join(F.broadcast(slices), "length")
              .withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_slices"))).drop("_slices"))
    before = (sliced.groupBy("length", "_slice").agg(F.count("*").alias("n"))
              .select("length", "_slice", (F.sum("n").over(Window.partitionBy("length").orderBy("_slice")) - F.col("n")).alias("_before")))
    order = [F.col("doc_id"), F.col("piece"), *(F.col(c) for c in pieces.columns if c not in ("doc_id", "piece"))]
    rank = F.row_number().over(Window.partitionBy("length", "_slice").orderBy(*order)) - 1
    # the rank is materialised by its window before the join with the offsets
    ranked = sliced.withColumn("_row", rank).join(before, ["length", "_slice"]).withColumn("_rank", F.col("_row") + F.col("_before"))
    p, s = ranked.alias("p"), table.alias("s")
    return (p.join(s, (F.col("p.length") == F.col("s.length")) & (F.col("p._rank") >= F.col("s.rank0"))
                   & (F.col("p._rank") < F.col("s.rank0") + F.col("s.n")))
            .select(*[F.col(f"p.{c}").alias(c) for c in pieces.columns],
                    (F.col("s.seq0") + F.col("p._rank") - F.col("s.rank0")).alias("sequence_id"), F.col("s.offset").alias("offset")))


def best_fit_packing(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return (pack(tokenized_pieces(docs, tokenizer_file, capacity, end_id), capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
