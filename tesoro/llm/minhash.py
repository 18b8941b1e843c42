"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

1. Every text becomes its set of word shingles (64-bit codes).  Texts with the
   same set are one node from here on, so exact copies cost nothing more.
2. Signature: the codes fall into ``BUCKETS`` buckets; of the smallest code in
   each a 16-bit register keeps the number of leading zeros and ten mantissa
   bits.  Empty buckets borrow from the next filled one.
3. Banding: four registers a band; nodes that share a band meet.  At the
   default similarity 0.8 a linked pair misses all 32 bands with a chance of
   5e-8 (6e-11 at 0.85).
4. Where nodes meet, the collision-corrected Jaccard estimate (less five
   standard errors) and the sizes decide on candidates.  Of each meeting only
   its trees are written, as stars around their smallest node, never all pairs.
5. Candidates are joined into clusters.  Within a cluster the links are
   confirmed on full sets with integers, again as trees: a pair is compared
   only while its two sides are not yet connected.

Meetings and clusters of any size are cut into tiles of about ``TILE`` nodes.
A large meeting compares all pairs of tiles of small registers; a large
cluster first compares every tile together with the cluster's smallest node,
then only nodes not yet connected with it against the other tiles.  Nothing
is capped.

Defined results: null texts and texts without words have empty sets and are
linked with nothing; a row is a document; a repeated doc_id names several
documents, and sets whose smallest doc_id is the same count as linked; null
ids never become a component_id (a component of null ids only has none, and
all its rows are kept); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import fresh, row_keys, smallest_labels, stage, text_of

BUCKETS = 128
BAND = 4
MANTISSA = 10
TILE = 1000
#: Ids given to sets that only rows without doc_id have start here.
NO_ID = 1 << 62
_BASE, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mix(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts -> sorted distinct shingle codes.

    A word's code comes from prefix sums of a polynomial over the bytes, so a
    whole batch is hashed by array operations."""

    def __init__(self, n: int):
        import numpy as np
        self.n = n
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self.back = np.uint64(pow(_BASE, -1, 1 << 64))

    def _powers(self, size: int):
        import numpy as np
        if len(self.power) <= size:
            for name, x in (("power", np.uint64(_BASE)), ("inverse", self.back)):
                p = np.full(size + 1, x, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sets(self, texts: list[str]):
        """One array of codes a text, in groups of about a million bytes."""
        group, size = [], 0
        for t in texts:
            data = t.encode("utf-8", "surrogatepass").lower()
            if group and size + len(data) > 1 << 20:
                yield from self._group(group)
                group, size = [], 0
            group.append(data)
            size += len(data) + 1
        if group:
            yield from self._group(group)

    def _group(self, group: list[bytes]):
        import numpy as np
        data = np.frombuffer(b" " + b" ".join(group) + b" ", np.uint8)
        self._powers(len(data))
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        start = np.nonzero(blank[:-1] & ~blank[1:])[0] + 1
        end = np.nonzero(~blank[:-1] & blank[1:])[0] + 1
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum(_mix(data + np.uint64(1)) * self.power[:len(data)], dtype=np.uint64)]
            word = _mix((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))
            n = self.n
            codes = np.zeros(len(word), np.uint64)
            if len(word) >= n:
                acc = np.zeros(len(word) - n + 1, np.uint64)
                for i in range(n):
                    acc = _mix(acc + word[i:len(word) - n + 1 + i] + np.uint64(i + 1))
                codes[:len(acc)] = acc
            at = np.cumsum([1] + [len(x) + 1 for x in group])
            first = np.searchsorted(start, at)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if b - a >= n:
                    yield np.unique(codes[a:b - n + 1])
                elif b > a:  # fewer words: the whole sequence
                    acc = np.zeros(1, np.uint64)
                    for i, w in enumerate(word[a:b]):
                        acc = _mix(acc + w + np.uint64(1000 + i))
                    yield acc
                else:
                    yield np.zeros(0, np.uint64)


def registers(sets: list):
    """HyperMinHash registers (uint16, one row a set; the sets are not empty)."""
    import numpy as np
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), sizes)
    shift = 64 - BUCKETS.bit_length() + 1
    bucket = (flat >> np.uint64(shift)).astype(np.int64)
    cell = of * BUCKETS + bucket
    first = np.r_[True, cell[1:] != cell[:-1]]      # sets are sorted, so the first of a cell is its smallest
    rest = (flat[first] & np.uint64((1 << shift) - 1)) >> np.uint64(shift - 53)
    length = np.frexp(rest.astype(np.float64))[1]
    zeros = 53 - length
    mantissa = ((rest << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(len(sets) * BUCKETS, np.int64)
    full = np.zeros(len(sets) * BUCKETS, bool)
    out[cell[first]] = zeros * (1 << MANTISSA) + mantissa.astype(np.int64)
    full[cell[first]] = True
    out, full = out.reshape(-1, BUCKETS), full.reshape(-1, BUCKETS)
    # next filled bucket to the right, around the end
    place = np.where(np.hstack([full, full]), np.arange(2 * BUCKETS), 4 * BUCKETS)
    ahead = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS]
    far = ahead - np.arange(BUCKETS)
    return ((np.take_along_axis(out, ahead % BUCKETS, 1) + 40503 * far) % 65536).astype(np.uint16)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, k1, k2, n, s1, s2 (the set's code), regs; one row a document."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        shingler = Shingler(words)
        for b in batches:
            sets = list(shingler.sets(b.column(3).to_pylist()))
            n = np.array([len(s) for s in sets], np.int64)
            some = [i for i, s in enumerate(sets) if len(s)]
            s1, s2, regs = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64), [None] * len(sets)
            for at in range(0, len(some), 500):
                part = some[at:at + 500]
                for i, r in zip(part, registers([sets[i] for i in part])):
                    regs[i] = r.tobytes()
            for i in some:
                s1[i], s2[i] = _mix(sets[i] ^ np.uint64(_BASE)).sum(dtype=np.uint64), _mix(sets[i]).sum(dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n), pa.array(s1.view(np.int64)),
                                              pa.array(s2.view(np.int64)), pa.array(regs, pa.binary())],
                                             names=["doc_id", "k1", "k2", "n", "s1", "s2", "regs"])

    return row_keys(text_of(docs)).select("doc_id", "k1", "k2", "text").mapInArrow(run, "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, regs binary")


class Forest:
    """Union-find over a tile whose rows are sorted by node.  Rows of the same
    node (an id with several sets) are one from the start."""

    def __init__(self, node: list[int]):
        import numpy as np
        self.node = np.array(node)
        self.label = np.maximum.accumulate(np.where(np.r_[True, self.node[1:] != self.node[:-1]], np.arange(len(node)), 0))

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.label[i], self.label[j]))
        if a != b:
            self.label[self.label == b] = a

    def stars(self) -> list[tuple[int, int]]:
        """(node, the smallest node of its tree) of all nodes but those."""
        import numpy as np
        off = np.nonzero(self.node != self.node[self.label])[0]
        return list(dict.fromkeys(zip(self.node[off].tolist(), self.node[self.label[off]].tolist())))


def _grouped(batches, fn, key_columns: int, names: list[str]):
    """Feed sorted rows to ``fn(columns of one group) -> (a, b) lists``,
    carrying an unfinished group over to the next batch."""
    import numpy as np
    import pyarrow as pa
    kept = None

    def flush(table):
        keys = [table.column(i).to_numpy(zero_copy_only=False) for i in range(key_columns)]
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        return np.r_[np.nonzero(change)[0], table.num_rows]

    def run(table, cuts):
        a, b = [], []
        cols = [table.column(i).to_pylist() for i in range(key_columns, table.num_columns)]
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if y - x > 1:
                for i, j in fn(*[c[x:y] for c in cols]):
                    a.append(i)
                    b.append(j)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=names)

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
        t = t.combine_chunks()
        cuts = flush(t)
        if len(cuts) > 2:
            yield run(t.slice(0, cuts[-2]), cuts[:-1])
        kept = t.slice(cuts[-2])
    if kept is not None and kept.num_rows:
        kept = kept.combine_chunks()
        yield run(kept, flush(kept))


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """a, b: every band's meeting as stars, which connect its nodes as its
    candidate pairs do."""
    bands = nodes.select("node", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("regs", 2 * BAND * i + 1, 2 * BAND)) for i in range(BUCKETS // BAND)])).alias("key"))
    # written, so that the join with it can split a hot band over tasks
    sizes = stage(bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "near-bands")
    met = bands.join(sizes, "key").withColumn("tiles", F.ceil(F.col("m") / (2 * TILE)))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    # every pair of tiles of a meeting is one group; a small meeting is one tile
    met = (met.withColumn("t", tile).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
           .select("key", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "node"))
    rows = (met.join(nodes.select("node", "n", "regs"), "node").select("key", "lo", "hi", "node", "n", "regs")
            .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node"))

    def meet(node, n, regs):
        import numpy as np
        r = np.frombuffer(b"".join(regs), np.uint16).reshape(len(node), BUCKETS)
        size = np.array(n, float)
        forest = Forest(node)
        chance = 0.5 / (1 << MANTISSA)      # that registers of different minima agree
        for i in range(len(node) - 1):
            rest = i + 1 + np.nonzero(forest.label[i + 1:] != forest.label[i])[0]
            if not len(rest):
                continue
            share = (r[rest] == r[i]).mean(axis=1)
            estimate = (share - chance) / (1 - chance)
            small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
            error = 5 * np.sqrt(threshold * (1 - threshold) / np.minimum(BUCKETS, small))
            for j in rest[(estimate >= threshold - error) & (small >= threshold * large - 1e-9)]:
                forest.join(i, int(j))
        return forest.stars()

    return rows.mapInArrow(lambda batches: _grouped(batches, meet, 3, ["a", "b"]), "a long, b long")


def confirmed_edges(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: stars that connect the nodes of each group (cluster, lo, hi) of
    ``rows`` (cluster, lo, hi, node, text) as the true links do; b is the
    smallest node of its star."""
    def meet(node, text):
        import numpy as np
        sets = list(Shingler(words).sets(text))
        size = np.array([len(s) for s in sets])
        forest = Forest(node)
        as_set: dict[int, set] = {}

        def own(i):
            if i not in as_set:
                as_set[i] = set(sets[i].tolist())
            return as_set[i]

        def linked(common, i, j):
            return 100 * common >= percent * (size[i] + size[j] - common)

        flat = owner = None
        for i in range(len(node) - 1):
            rest = i + 1 + np.nonzero(forest.label[i + 1:] != forest.label[i])[0]
            rest = rest[100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])]
            if len(rest) > 64:
                # many partners: count shared codes through the sorted codes of the tile
                if flat is None:
                    order = np.argsort(np.concatenate(sets), kind="stable")
                    flat, owner = np.concatenate(sets)[order], np.repeat(np.arange(len(sets)), size)[order]
                lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
                count = np.zeros(len(node), np.int64)
                n = hi - lo
                hit = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                count += np.bincount(owner[hit], minlength=len(node))
                common = count[rest]
                for j in rest[linked(common, i, rest)]:
                    forest.join(i, int(j))
            else:
                for j in rest.tolist():
                    if forest.label[i] != forest.label[j] and linked(len(own(i) & own(j)), i, j):
                        forest.join(i, j)
        return forest.stars()

    rows = (rows.select("cluster", "lo", "hi", "node", "text").repartition("cluster", "lo", "hi")
            .sortWithinPartitions("cluster", "lo", "hi", "node"))
    return rows.mapInArrow(lambda batches: _grouped(batches, meet, 3, ["a", "b"]), "a long, b long")


def cluster_labels(members: DataFrame, words: int, percent: int) -> DataFrame:
    """node, label: the component, by its smallest node, of every linked node
    of the clusters ``members`` (cluster, node, k1, k2, text).  A node whose
    id stands for several texts has a row for each.

    A cluster of one tile is resolved where it is compared; only the stars of
    larger ones are joined by steps over the edges."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"), F.min("node").alias("center"))
    sizes = stage(sizes.withColumn("tiles", F.ceil(F.col("m") / TILE)), "near-sizes")
    rows = members.join(sizes, "cluster")
    zero = F.lit(0).cast("long")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    all_tiles = F.sequence(zero, F.col("tiles") - 1)

    def resolved(stars):
        found = stars.select(F.col("a").alias("node"), F.col("b").alias("label"))
        return found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())

    one_tile = rows.where("tiles = 1").withColumn("lo", zero).withColumn("hi", zero)
    done = resolved(stage(confirmed_edges(one_tile, words, percent), "near-links"))
    large = sizes.where("tiles > 1")
    if not large.take(1):
        return done
    # the smallest node joins every tile of its cluster
    first = rows.where("tiles > 1").withColumn("lo", F.explode(F.when(F.col("node") == F.col("center"), all_tiles).otherwise(F.array(tile))))
    edges = stage(confirmed_edges(first.withColumn("hi", F.col("lo")), words, percent), "near-links")
    label = smallest_labels(edges, name="near-first")
    mine = members.join(large, "cluster").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = mine.where(F.col("label") != F.col("center"))       # a component with the center has it as label
    left = apart.groupBy("cluster").agg(F.count("*").alias("r")).withColumn("parts", F.ceil(F.col("r") / TILE))
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts"))
    open_rows = mine.join(left, "cluster")
    one = (open_rows.where(F.col("label") != F.col("center")).withColumn("lo", part).withColumn("hi", F.explode(all_tiles)))
    two = open_rows.withColumn("hi", tile).withColumn("lo", F.explode(F.sequence(zero, F.col("parts") - 1)))
    both = one.select("cluster", "lo", "hi", "node", "k1", "k2", "text").unionByName(two.select("cluster", "lo", "hi", "node", "k1", "k2", "text"))
    both = both.dropDuplicates(["cluster", "lo", "hi", "node", "k1", "k2"])
    return done.unionByName(smallest_labels(edges.unionByName(confirmed_edges(both, words, percent)), name="near-components"))


def components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, k1, k2, n_shingles, component_id, kept.  Documents are linked
    when ``100 * intersection >= percent * union`` of their shingle sets."""
    sig = stage(signatures(docs, words), "near-sig")
    ids = F.coalesce(F.min("doc_id"), F.lit(NO_ID) + F.pmod(F.xxhash64("s1", "s2"), F.lit(NO_ID)))
    nodes = stage(sig.where("n > 0").groupBy("s1", "s2", "n").agg(
        ids.alias("node"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("row"), F.first("regs").alias("regs"))
        .select("s1", "s2", "n", "node", "row.k1", "row.k2", "regs"), "near-nodes")
    cluster = smallest_labels(candidate_edges(nodes, percent / 100), name="near-candidates")
    wanted = nodes.select("node", "k1", "k2").join(cluster, "node").select("k1", "k2", "node", F.col("label").alias("cluster"))
    texts = row_keys(text_of(docs))
    members = stage(wanted.join(texts.select("k1", "k2", "text"), ["k1", "k2"]).select("cluster", "node", "k1", "k2", "text")
                    .dropDuplicates(["cluster", "node", "k1", "k2"]), "near-members")
    label = cluster_labels(members, words, percent)
    named = (nodes.select("s1", "s2", "n", "node").join(label, "node", "left")
             .select("s1", "s2", "n", F.coalesce("label", "node").alias("c")))
    some = sig.where("n > 0").join(named, ["s1", "s2", "n"]).select(
        "doc_id", "k1", "k2", "n", F.when(F.col("c") < NO_ID, F.col("c")).alias("component_id"))
    none = sig.where("n = 0").select("doc_id", "k1", "k2", "n", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id",
                                         F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents of smallest id of each component, all columns as they
    are; of rows equal in id and text one stays."""
    found = components(docs, words, percent)
    a, b = fresh(docs, "k1", "k2")
    gone = found.where(~F.col("kept")).select(F.col("k1").alias(a), F.col("k2").alias(b)).distinct()
    out = row_keys(docs, a, b).join(gone, [a, b], "left_anti")
    repeated = found.where("kept").groupBy("k1", "k2").agg(F.count("*").alias("rows")).where("rows > 1")
    if repeated.take(1):
        out = out.dropDuplicates([a, b])
    return out.select(*docs.columns)
