"""Exact top-k inner-product search over an impact-ordered index.

Every block of vectors is indexed by impact: a component v has the quantised
impact ``|v| // step`` and the posting segments of one impact are kept
together.  Scores grow segment by segment, the highest impact first.  What is
still to come is bounded by the query's weights times the block's largest
remaining impact in each dimension; a block stops as soon as the bounds prove
that nothing outside a small set of possible members can reach the query's
k-th score.  Those are rescored exactly in integers.

The queries are a stated set; they are taken in blocks of about
``query_block`` (the only data sent from the driver, so bounded) and each
block meets all vectors in one pass.

Defined results: vectors that are null or hold null, NaN or infinite
components take no part, nor do rows without vec_id; a row repeated exactly
counts once; vectors of another length than the query's are no candidates;
ties go to the smaller vec_id; components and scores beyond the range of long
are held to its ends; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 4096
VECTOR_BLOCK = 4096
STEP = 16
#: A block stops when at most this share of its vectors are possible members.
STOP_SHARE = 0.02


def integer_vectors(df: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return (df.where(v.isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v")).distinct())


class ImpactIndex:
    """One block of integer vectors, its postings grouped by impact."""

    def __init__(self, ids, vectors):
        import numpy as np
        self.ids, self.v = ids, vectors
        impact = np.abs(vectors) // STEP
        self.levels = [int(x) for x in np.unique(impact)[::-1]]
        self.segments = {x: np.where(impact == x, vectors, 0).astype(float) for x in self.levels}
        below = [np.where(impact < x, np.abs(vectors), 0).max(axis=0, initial=0) for x in self.levels]
        self.rest = dict(zip(self.levels, below))

    def search(self, queries, own, floor, k: int):
        """Pairs (query row, vector row) that may be among the k best and
        reach ``floor``; ``own`` is the id that is no candidate."""
        import numpy as np
        n = len(self.ids)
        scores = np.zeros((len(queries), n))
        mine = own[:, None] == self.ids[None, :]
        weight = np.abs(queries).astype(float)
        for x in self.levels:
            scores += queries.astype(float) @ self.segments[x].T
            rest = (weight @ self.rest[x].astype(float))[:, None]
            lower = np.where(mine, -np.inf, scores - rest)
            least = np.maximum(np.partition(lower, n - k, axis=1)[:, n - k] if n > k else -np.inf, floor)
            possible = (scores + rest >= least[:, None]) & ~mine
            if possible.sum() <= max(k * len(queries), STOP_SHARE * possible.size):
                break
        return np.nonzero(possible)


def _top(score, vec_id, group, k: int):
    """Row numbers of the k best of every group: highest score, then smallest id."""
    import numpy as np
    order = np.lexsort((vec_id, -score, group))
    g = group[order]
    first = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0)) if len(g) else np.zeros(0, int)
    return order[np.arange(len(g)) - start < k]


def _searcher(queries: list[tuple[int, list[int]]], k: int):
    """mapInArrow function: k best of each query among a task's vectors."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        by_len: dict[int, list[int]] = {}
        for i, (_, v) in enumerate(queries):
            by_len.setdefault(len(v), []).append(i)
        best: dict[int, list] = {}

        def meet(length, ids, vectors):
            rows = by_len.get(length)
            if rows is None or not len(ids):
                return
            q = np.array([queries[i][1] for i in rows], dtype=np.int64).reshape(len(rows), length)
            own = np.array([queries[i][0] for i in rows], dtype=np.int64)
            if length not in best:
                best[length] = [np.zeros(0, np.int64)] * 3 + [np.full(len(rows), -np.inf)]
            group, vec, score, floor = best[length]
            most = [max(1, abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (q, vectors)]
            big = most[0] * most[1] * max(1, length)
            if big < 2 ** 52:  # sums of products are exact in doubles
                a, b = ImpactIndex(ids, vectors).search(q, own, floor, k)
            else:
                a, b = np.nonzero(own[:, None] != ids[None, :])
            exact = []
            for at in range(0, len(a), 1 << 18):
                x, y = q[a[at:at + (1 << 18)]], vectors[b[at:at + (1 << 18)]]
                if big < 2 ** 62:
                    exact.append((x * y).sum(axis=1))
                else:  # beyond 64 bits: Python integers, held to the range of long
                    sums = (x.astype(object) * y.astype(object)).sum(axis=1)
                    exact.append(np.array([min(max(s, -2 ** 63), 2 ** 63 - 1) for s in sums], dtype=np.int64))
            group = np.concatenate([group, a])
            vec = np.concatenate([vec, ids[b]])
            score = np.concatenate([score, *exact])
            keep = _top(score, vec, group, k)
            group, vec, score = group[keep], vec[keep], score[keep]
            full = np.bincount(group, minlength=len(rows)) >= k
            low = np.full(len(rows), np.inf)
            np.minimum.at(low, group, score.astype(float))
            best[length] = [group, vec, score, np.where(full, low, -np.inf)]

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.r_[0, np.cumsum(lengths)]
            for length in np.unique(lengths):
                rows = np.nonzero(lengths == length)[0]
                for at in range(0, len(rows), VECTOR_BLOCK):
                    part = rows[at:at + VECTOR_BLOCK]
                    meet(int(length), ids[part], flat[starts[part][:, None] + np.arange(length)].reshape(len(part), length))
        for length, (group, vec, score, _) in best.items():
            rows = np.array(by_len[length])[group]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array([queries[i][0] for i in rows], pa.int64()), pa.array(vec), pa.array(score)],
                names=["q", "query_id", "vec_id", "score"])

    return run


def exact_top_k(vectors: DataFrame, is_query, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``vectors`` from :func:`integer_vectors`; ``is_query`` a condition on
    vec_id.  Returns query_id, rank, vec_id, score."""
    total = vectors.where(is_query).count()
    blocks = max(1, -(-total // query_block))
    found = None
    for i in range(blocks):
        mine = vectors.where(is_query & (F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == i))
        rows = [(r["vec_id"], r["v"]) for r in mine.collect()]  # one block of queries
        part = vectors.mapInArrow(_searcher(rows, k), "q int, query_id long, vec_id long, score long").withColumn("block", F.lit(i))
        found = part if found is None else found.unionByName(part)
    w = Window.partitionBy("block", "q").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
