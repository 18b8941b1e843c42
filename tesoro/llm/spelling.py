"""Spelling variants: words one edit apart, each led to a commoner form.

1. Words are the maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole
   texts, with A-Z in lower case, counted in every task before the shuffle.
2. Near words by asymmetric q-chunks: with q = half its length, a word gives
   two disjoint chunks of q code points, and every word all of its positional
   q-grams for the q of words as long as itself or one shorter.  An edit
   touches one chunk at most, so of two words one edit apart the shorter (or
   either, if equally long) has a chunk that stands in the other, shifted by at
   most one place.  Chunks and grams meet by an equi join on length, chunk
   number, shift and text; the distance of exactly one is verified as part of
   the join, so only near pairs leave it.
3. A chunk shared by many words is dealt in tiles of about ``TILE`` words on
   either side, so that no key compares more than the square of that in a task.
4. A word's form is its near word of largest count (ties: the smallest by code
   points) if that is at least ``RATIO`` times its own.  Counts at least double
   along forms, so the way to the root is at most log2(largest count) long;
   pointers are doubled until none moves.

Defined results: null texts hold no words; a null doc_id is an empty text in
the hash of the typing slips; a repeated row counts again; no word is too long;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import map_rows, stage, text_of

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
#: Words of one key that are compared in one tile.
TILE = 2000
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 500_000


def word_counts(docs: DataFrame, slip: int = 0, least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, n over all texts.  With ``slip``, a run loses the code point
    ``h % length`` in texts where ``slip`` divides h, the crc32 of
    ``<doc_id>:<run>``."""
    def run(batches):
        import zlib
        from collections import Counter
        # in Latin-1 a code point is a byte; whatever is no letter becomes a space
        fold = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
        held: Counter = Counter()

        def flush():
            rows = [(w.decode("latin-1"), n) for w, n in held.items()]
            held.clear()
            return rows

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = Counter(text.as_py().encode("latin-1", "replace").translate(fold).split())
                if slip:
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    moved = []
                    for w in own:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if not h % slip:
                            moved.append((w, h % len(w)))
                    slipped: Counter = Counter()
                    for w, at in moved:
                        slipped[w[:at] + w[at + 1:]] += own.pop(w)
                    own.update(slipped)
                for w, n in own.items():
                    if len(w) >= least_length:
                        held[w] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        yield flush()

    return map_rows(text_of(docs), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """a, b: every two of the distinct ``word`` (at least two code points)
    that are exactly one edit apart, once, the shorter first (or the smaller,
    if equally long)."""
    word, zero = F.col("word"), F.lit(0).cast("long")

    def half(size):
        return F.floor(size / 2).cast("int")

    def chunks():
        size = F.length(word)
        return F.array(*[F.struct(size.alias("size"), F.lit(j).alias("chunk"), F.substring(word, F.lit(1) + j * half(size), half(size)).alias("text"))
                         for j in (0, 1)])

    def grams(shorter: int):
        """Positional grams for partners shorter by 0 or 1, as the chunk they
        can equal: its place is j * q, theirs up to ``shorter`` behind it."""
        size = F.length(word) - shorter
        q = half(size)
        all_grams = F.transform(F.sequence(F.lit(0), F.length(word) - q), lambda p: F.struct(p.alias("place"), F.substring(word, p + 1, q).alias("text")))
        return [F.transform(F.filter(all_grams, lambda g: g["place"].between(j * q, j * q + shorter)),
                            lambda g: F.struct(size.alias("size"), F.lit(j).alias("chunk"), g["text"].alias("text"))) for j in (0, 1)]

    key = ["size", "chunk", "text"]
    left = words.select(word.alias("a"), F.explode(chunks()).alias("k")).select("a", "k.*")
    right = (words.select(word.alias("b"), F.explode(F.array_distinct(F.concat(*grams(0), *grams(1)))).alias("k"))
             .select("b", "k.*").where("size > 1"))
    # a key has at least as many grams as chunks: every chunk is a gram of its own word
    crowd = right.groupBy(*key).agg(F.count("*").alias("m")).where(F.col("m") > tile)
    crowd = stage(crowd.select(*key, F.ceil(F.col("m") / tile).alias("tiles")), "spell-crowds")
    tiles = F.coalesce("tiles", F.lit(1).cast("long"))
    every, one = F.explode(F.sequence(zero, tiles - 1)), lambda c: F.pmod(F.xxhash64(c), tiles)
    left = left.join(crowd, key, "left").withColumn("lo", one("a")).withColumn("hi", every).drop("tiles")
    right = right.join(crowd, key, "left").withColumn("hi", one("b")).withColumn("lo", every).drop("tiles")
    keys = [*key, "lo", "hi"]
    left, right = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    once = (F.length("b") > F.col("l.size")) | (F.col("a") < F.col("b"))
    return left.join(right, [*same, once, F.levenshtein("a", "b", 1) == 1]).select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form), a forest with only words that have a form:
    pointers are doubled until none moves."""
    at = stage(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        ahead = at.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        step = stage(at.join(ahead, F.col("root") == F.col("_word"), "left")
                     .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spell-roots")
        at = step.drop("moved")
        if not step.where("moved").take(1):
            return at


def variants(counts: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words with counts."""
    counts = stage(counts.select("word", "n"), "spell-words")
    pairs = stage(near_pairs(counts.select("word"), tile), "spell-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    other = counts.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = both.join(other, "other").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top"))
    top_n = -F.col("top.less")
    found = counts.join(near, "word", "left").withColumn("led", top_n >= ratio * F.col("n"))
    found = stage(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(F.col("led"), F.col("top.other")).alias("form"), F.when(F.col("led"), top_n).alias("form_n")), "spell-forms")
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, slip: int = 0, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """As ``variants`` for the words of ``docs`` with at least ``least_length``
    code points (two at the least) and ``least_count`` occurrences."""
    counts = word_counts(docs, slip, max(2, least_length)).where(F.col("n") >= least_count)
    return variants(counts, ratio, tile)


def normalised(docs: DataFrame, **options) -> DataFrame:
    """doc_id, word, root: each document's words that have another root, to
    rewrite texts with.  Joined on the word, so no table of words is held."""
    found = spelling_variants(docs, **options).where("word <> root").select("word", "root")
    words = (text_of(docs).select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("[a-z\\u00C0-\\u00FF]+"), F.lit(0)))).alias("word")))
    return words.join(found, "word").select("doc_id", "word", "root")


#: The query of the driver tables in DuckDB SQL: crc32 by a fold over bytes
#: with a table made from its polynomial; near words by equal deletions.
ORACLE = """
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], range(8)),
             lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS w FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(s, ''),
           lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195, CAST(ord(x) - 64 AS BIGINT)] END))),
           lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]))) AS h
  FROM (SELECT w, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS s FROM runs), tab),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substring(w, 1, CAST(h % length(w) AS INT)) || substring(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, p, substring(word, 1, CAST(p AS INT)) || substring(word, CAST(p AS INT) + 2) AS d
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.d = b.d AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.d = b.word),
top AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
         CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN top USING (word)),
way AS (
  SELECT word, word AS at FROM found
  UNION ALL SELECT y.word, f.form FROM way y JOIN found f ON f.word = y.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, y.at AS root, f.n, f.n_near, f.form_n
FROM found f JOIN way y USING (word) JOIN found e ON e.word = y.at WHERE e.form IS NULL
"""
