"""Removal of repeated runs of lines by content-defined chunking, with
DataFrame functions only.

Each line has a hash; a hash rolled over every two neighbouring line hashes
decides where a chunk ends (5 of 16 places on average).  Boundaries depend on
the two lines alone, so a run of lines that moved to another place or document
is cut at the same places inside.  Chunks of ``MIN_LINES`` lines or more that
occur again anywhere in the corpus are removed, except their first occurrence
(smallest doc_id, then place), after their bytes were compared with it.

Chunk counts are partial aggregates on hashes, so a chunk in a third of all
documents is one row a task.  Texts are shuffled by document, never by chunk
hash, except the chunks that occur more than once, for their comparison; that
join has one row a hash on one side, and a hot hash on the other can be split.

``whole_runs`` takes every two neighbouring lines instead of the chunks: a run
of ``MIN_LINES`` lines or more that stands earlier in the corpus is made of
pairs that do, so all its lines go whatever surrounds it.  The earliest place
of a line is never removed.

Defined results: null texts are left as they are; empty lines are lines; rows
equal in id and text count as one document (both get its text); null ids come
last in the order; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import fresh, row_keys, stage

MIN_LINES = 2
#: A boundary follows where the first hexadecimal digit of the rolled hash is smaller.
CUT_BELOW = "5"


def chunks(text: Column) -> Column:
    """Array of chunks.  Inside a chunk every line is preceded by ``|``, so
    that an empty line differs from the boundary ``\\n\\n`` used to split."""
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda x: F.md5(x))
    rolled = F.zip_with(F.concat(F.array(F.lit(None).cast("string")), hashes), hashes, lambda a, b: F.md5(F.concat(a, b)))
    marked = F.zip_with(lines, rolled, lambda x, h: F.concat(
        F.lit("|"), x, F.when(F.substring(h, 1, 1) < CUT_BELOW, F.lit("\n")).otherwise(F.lit(""))))
    # rolled is one longer than lines: its last element has no line and gives null, which array_join leaves out
    return F.split(F.regexp_replace(F.array_join(marked, "\n"), "\n\\z", ""), "\n\n", -1)


def unmarked(kept: Column) -> Column:
    """Text of an array of chunks."""
    return F.substr(F.replace(F.concat(F.lit("\n"), F.array_join(kept, "\n")), F.lit("\n|"), F.lit("\n")), F.lit(2))


def n_lines(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def repeated_chunks(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """k1, k2 (of the row), removed: places of the chunks to remove."""
    texts = row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL"))
    parts = texts.select("doc_id", "k1", "k2", F.posexplode(chunks(F.col("text"))).alias("pos", "chunk"))
    keys = stage(parts.where(n_lines(F.col("chunk")) >= min_lines)
                 .select("doc_id", "k1", "k2", "pos", F.xxhash64("chunk").alias("c"), F.length("chunk").alias("size")), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k1", "k2", "pos")
    # written, so that the join below can split a hot hash over tasks
    groups = stage(keys.groupBy("c", "size").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .where(F.col("first") != F.col("last")).select("c", "size", "first"), "line-groups")
    asked = stage(keys.join(groups, ["c", "size"]).select(
        "k1", "k2", "pos", "c", "size",
        ((F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2")) & (F.col("pos") == F.col("first.pos"))).alias("is_first")).distinct(), "line-asked")
    by_doc = asked.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "c", "size", "is_first")).alias("asked"))
    with_text = (texts.select("k1", "k2", "text").join(by_doc, ["k1", "k2"])
                 .select("k1", "k2", "asked", chunks(F.col("text")).alias("chunks")))
    # the places asked for stand beside the chunks
    beside = (with_text.select("k1", "k2", "asked", F.posexplode("chunks").alias("pos", "chunk"))
              .withColumn("a", F.filter("asked", lambda a: a["pos"] == F.col("pos"))).where(F.size("a") > 0)
              .select("k1", "k2", "pos", "chunk", F.col("a")[0]["c"].alias("c"), F.col("a")[0]["size"].alias("size"), F.col("a")[0]["is_first"].alias("is_first")))
    beside = stage(beside.dropDuplicates(["k1", "k2", "pos"]), "line-texts")
    first = beside.where("is_first").select("c", "size", F.col("chunk").alias("original"))
    same = beside.where("NOT is_first").join(first, ["c", "size"]).where(F.col("chunk") == F.col("original"))
    return same.groupBy("k1", "k2").agg(F.collect_set("pos").alias("removed"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """k1, k2 (of the row), removed: places of the lines in a pair of lines
    that stands earlier, without overlap."""
    texts = row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL"))
    lines = F.split("text", "\n", -1)
    hashed = texts.where(F.instr("text", "\n") > 0).select("doc_id", "k1", "k2", F.transform(lines, lambda x: F.xxhash64(x)).alias("h"))
    pairs = F.zip_with(F.slice("h", F.lit(1), F.size("h") - 1), F.slice("h", F.lit(2), F.size("h") - 1), lambda a, b: F.xxhash64(a, b))
    keys = stage(hashed.select("doc_id", "k1", "k2", F.posexplode(pairs).alias("pos", "c")), "line-pairs")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k1", "k2", "pos")
    # written, so that the join below can split a hot hash over tasks
    groups = stage(keys.groupBy("c").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .where(F.col("first") != F.col("last")).select("c", "first"), "line-groups")
    same_row = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    asked = stage(keys.join(groups, "c").where(~(same_row & (F.col("pos") == F.col("first.pos") + 1)))
                  .select("k1", "k2", "pos", "c", (same_row & (F.col("pos") == F.col("first.pos"))).alias("is_first")).distinct(), "line-asked")
    by_doc = asked.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "c", "is_first")).alias("asked"))
    with_text = (texts.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).join(by_doc, ["k1", "k2"])
                 .select("k1", "k2", "asked", lines.alias("lines")))
    beside = stage(with_text.select("k1", "k2", F.explode(F.transform("asked", lambda a: F.struct(
        a["pos"].alias("pos"), a["c"].alias("c"), a["is_first"].alias("is_first"),
        F.concat_ws("\n", F.col("lines")[a["pos"]], F.col("lines")[a["pos"] + 1]).alias("pair")))).alias("a")).select("k1", "k2", "a.*"), "line-texts")
    first = beside.where("is_first").select("c", F.col("pair").alias("original"))
    same = beside.where("NOT is_first").join(first, "c").where(F.col("pair") == F.col("original"))
    return (same.groupBy("k1", "k2").agg(F.collect_set("pos").alias("at"))
            .select("k1", "k2", F.array_sort(F.array_union("at", F.transform("at", lambda p: p + 1))).alias("removed")))


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, counts: bool = True, whole_runs: bool = False) -> DataFrame:
    """docs with the repeated chunks (``whole_runs``: runs of two lines or
    more) cut out of ``text``, all other columns as they are; with ``counts``,
    n_lines, n_removed (lines) and n_chunks (removed; runs) follow (with
    underscores before a name that docs has)."""
    if whole_runs and min_lines != 2:
        raise ValueError("whole runs are found from two lines on")
    found = repeated_lines(docs) if whole_runs else repeated_chunks(docs, min_lines)
    a, b, gone, lines, cut, parts = fresh(docs, "_k1", "_k2", "_removed", "n_lines", "n_removed", "n_chunks")
    rows = row_keys(docs, a, b).join(found.withColumnsRenamed({"k1": a, "k2": b, "removed": gone}), [a, b], "left")
    text, removed = F.col("text"), F.col(gone)
    if whole_runs:
        rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(removed, i)), "\n")
    else:
        rest = unmarked(F.filter(chunks(text), lambda c, i: ~F.array_contains(removed, i)))
    kept = F.when(removed.isNull(), text).otherwise(rest)
    out = [kept.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    if counts:
        n = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
        pieces = F.filter(removed, lambda i: ~F.array_contains(removed, i - 1)) if whole_runs else removed
        cut_lines = F.when(removed.isNull(), F.lit(0)).otherwise(F.size(removed) if whole_runs else
            F.aggregate(F.filter(chunks(text), lambda c, i: F.array_contains(removed, i)), F.lit(0), lambda acc, c: acc + n_lines(c)))
        out += [F.coalesce(n, F.lit(0)).cast("long").alias(lines), cut_lines.cast("long").alias(cut),
                F.coalesce(F.size(pieces), F.lit(0)).alias(parts)]
    return rows.select(*out)


ORACLE = """
WITH line AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
flag AS (
  SELECT *, coalesce(lag(substr(md5(md5(prev) || md5(line)), 1, 1) < '5') OVER w, false) AS cut FROM (
    SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM line)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM flag),
chunk AS (
  SELECT doc_id, chunk, min(i) AS i0, count(*) AS n, string_agg('|' || line, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY doc_id, chunk),
judged AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY n >= 2, body ORDER BY doc_id, i0) > 1 AS gone FROM chunk),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) FILTER (WHERE NOT j.gone) AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE j.gone) AS n_removed
  FROM numbered n JOIN judged j ON n.doc_id = j.doc_id AND n.chunk = j.chunk GROUP BY n.doc_id)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce((SELECT count(*) FROM judged j WHERE j.doc_id = d.doc_id AND j.gone), 0)::INT AS n_chunks,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
