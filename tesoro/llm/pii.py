"""Information-theoretic sanitisation of personal data, with DataFrame
functions only.

1. Base spans: e-mail addresses, IP addresses, payment cards and phone numbers
   found by pattern and checked (parts up to 255, Luhn digit, digit counts).
2. The value of a base span is a protected entity.  The words within
   ``CONTEXT`` code points beside it are candidate terms.
3. Co-occurrence over the corpus says how strongly a term t reveals an entity
   e: ``P(e|t) = documents with t beside e / documents with t`` and the
   information gained ``log2(P(e|t) / P(e))``.  Document counts of terms cover
   all documents.
4. Terms seen beside the same entity in ``MIN_DOCS`` documents or more that
   exceed both thresholds are disclosed spans too (kind ``term``), wherever
   they stand beside that entity.
5. ``redact`` replaces spans: a base span by its kind, a term by a general
   label.

``whole`` takes whole documents instead of contexts: co-occurrence counts
every word of a document with every entity the document names, and a disclosed
term is a span wherever it stands, in documents that don't name the entity
too.  Entities and terms whose counts can't reach the thresholds are left out
before pairs are made, which changes no result.

The patterns are written so that each place of a text is tried once (no
nested repetition that could be re-entered), so very long runs stay linear.

Counts are partial aggregates by term and entity, so a word or an address in
a third of all documents is summed before it is shuffled.  Texts are read
twice and never shuffled; only contexts of base spans are.  With ``whole`` they
are read four times, and those that hold a disclosed term are shuffled by row
key.

Defined results: null texts are empty; every row is reported, repeated ones
and null ids too (rows equal in id and text share one set of spans); other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import row_keys, stage, text_of

KINDS = ["email", "ip", "card", "phone"]
CONTEXT = 120
MIN_DOCS = 2
MIN_SHARE = 0.5
MIN_BITS = 3.0

# A match can only begin where a run of the pattern's first characters begins,
# or where the last match ended (\G).  Possessive repetition (++) never gives
# characters back; none of the patterns needs them back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without it holds no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD = r"[\p{L}\p{N}]++"
#: Words and what lies between them: together the whole text.
PIECE = r"[\p{L}\p{N}]++|[^\p{L}\p{N}]++"
#: Stands for a base span while the words around it are read; no letter, no digit.
HOLE = "\ue000"


def matches(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(F.instr(text, NEEDS[kind]) > 0, found).otherwise(none) if NEEDS[kind] else found


def luhn(digits: Column) -> Column:
    parts = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(value: Column, kind: str) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def placed(text: Column, found: Column, pattern: str, context: int = 0) -> Column:
    """Array of (start, end, value, left, right) of the matches ``found``: the
    text between them gives their places."""
    # the gaps stand beside the matches as arrays, so the text is split once,
    # not once for each match
    gaps = F.split(text, pattern, -1)
    beside = F.zip_with(F.zip_with(found, gaps, lambda v, g: F.struct(v.alias("value"), g.alias("gap"))),
                        F.slice(gaps, 2, F.greatest(F.size(found), F.lit(1))),
                        lambda x, g: F.struct(x["value"].alias("value"), x["gap"].alias("gap"), g.alias("next")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>").alias("out"))

    def step(acc, x):
        gap, value = x["gap"], x["value"]
        start = acc["at"] + F.length(gap)
        left = F.when(F.length(gap) > context, F.substring(gap, -context, context)).otherwise(gap)
        span = F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                        (left if context else F.lit("")).alias("left"),
                        (F.substring(x["next"], 1, context) if context else F.lit("")).alias("right"))
        return F.when(value.isNull(), acc).otherwise(
            F.struct((start + F.length(value)).alias("at"), F.array_append(acc["out"], span).alias("out")))

    return F.when(F.size(found) > 0, F.aggregate(beside, zero, step, lambda acc: acc["out"])).otherwise(zero["out"])


def free_words(text: Column, spans: Column) -> Column:
    """The distinct words, in lower case, that touch no span."""
    plain = F.translate(text, HOLE, " ")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(plain, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(gap, F.lit(HOLE))).alias("out"))

    rest = F.aggregate(spans, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(plain, acc["at"] + 1, F.length(plain))))
    words = F.regexp_extract_all(rest, F.lit(r"[\p{L}\p{N}\x{E000}]++"), F.lit(0))
    return F.array_distinct(F.transform(F.filter(words, lambda w: F.instr(w, HOLE) == 0), lambda w: F.lower(w)))


def base_spans(docs: DataFrame, context: int = CONTEXT, words: bool = False) -> DataFrame:
    """doc_id, k1, k2 (row key) and ``spans``: array of (start, rank, kind,
    end, value, left, right), by start and then kind; with ``words`` the free
    words of the rows with spans."""
    d = row_keys(text_of(docs))
    d = d.select("*", *[matches(F.col("text"), k).alias(f"m_{k}") for k in KINDS])

    def of_kind(rank: int, kind: str) -> Column:
        ok = F.filter(placed(F.col("text"), F.col(f"m_{kind}"), PATTERNS[kind], context), lambda s: valid(s["value"], kind))
        return F.transform(ok, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"),
            s["value"].alias("value"), s["left"].alias("left"), s["right"].alias("right")))

    spans = [of_kind(rank, kind) for rank, kind in enumerate(KINDS)]
    if not words:
        return d.select("doc_id", "k1", "k2", F.array_sort(F.concat(*spans)).alias("spans"))
    free = F.when(F.size("spans") > 0, free_words(F.col("text"), F.col("spans"))).otherwise(F.array().cast("array<string>"))
    return (d.select("doc_id", "k1", "k2", "text", F.array_sort(F.concat(*spans)).alias("spans"))
            .select("doc_id", "k1", "k2", "spans", free.alias("words")))


def context_terms(base: DataFrame) -> DataFrame:
    """k1, k2, entity, term, start, end: the words beside each base span that
    lie whole in its context and in no base span."""
    s = base.select("k1", "k2", F.col("spans").alias("all"), F.explode("spans").alias("s"))
    lower = lambda c: F.lower(c)

    def side(text, offset, cut):
        text = F.col(text)
        words = placed(text, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), WORD)
        kept = F.filter(words, lambda w: cut(w, F.length(text)))
        return F.transform(kept, lambda w: F.struct(lower(w["value"]).alias("term"), (w["start"] + offset).alias("start"),
                                                    (w["end"] + offset).alias("end")))

    flat = s.select("k1", "k2", "all", F.col("s.value").alias("entity"), F.col("s.start").alias("s0"), F.col("s.end").alias("s1"),
                    F.col("s.left").alias("l"), F.col("s.right").alias("r"))
    # a word at the cut of a full context may be a part of a longer word
    both = F.concat(side("l", F.col("s0") - F.length("l"), lambda w, n: (w["start"] > 0) | (n < CONTEXT)),
                    side("r", F.col("s1"), lambda w, n: (w["end"] < n) | (n < CONTEXT)))
    out = flat.select("k1", "k2", "all", F.lower("entity").alias("entity"), F.explode(both).alias("t")).select("k1", "k2", "all", "entity", "t.*")
    free = ~F.exists("all", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    return out.where(free).select("k1", "k2", "entity", "term", "start", "end").distinct()


def document_counts(docs: DataFrame) -> DataFrame:
    """term, df over all documents."""
    t = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = F.array_distinct(F.split(t, r"[^\p{L}\p{N}]++"))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def disclosed_terms(docs: DataFrame, base: DataFrame, context: DataFrame, min_docs: int = MIN_DOCS,
                    min_share: float = MIN_SHARE, min_bits: float = MIN_BITS) -> DataFrame:
    """entity, term, share, bits of the terms that exceed the thresholds."""
    total = base.count()
    together = (context.select("entity", "term", "k1", "k2").distinct().groupBy("entity", "term")
                .agg(F.count("*").alias("both")).where(F.col("both") >= min_docs))
    entities = (base.select("k1", "k2", F.explode(F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))).alias("entity"))
                .distinct().groupBy("entity").agg(F.count("*").alias("held")))
    seen = document_counts(docs).join(together.select("term").distinct(), "term", "left_semi")
    share = F.least(F.col("both") / F.col("df"), F.lit(1.0))
    return (together.join(entities, "entity").join(seen, "term")
            .select("entity", "term", share.alias("share"), F.log2(share / (F.col("held") / F.lit(float(max(total, 1))))).alias("bits"))
            .where((F.col("share") >= min_share) & (F.col("bits") >= min_bits)))


def words_of(text: Column) -> Column:
    """The distinct words in lower case."""
    return F.array_distinct(F.transform(F.filter(F.split(text, r"[^\p{L}\p{N}]++"), lambda w: w != ""), lambda w: F.lower(w)))


def whole_terms(docs: DataFrame, base: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
                min_bits: float = MIN_BITS) -> DataFrame:
    """entity, term, share, bits of the terms that exceed the thresholds,
    counted over whole documents."""
    total = float(max(base.count(), 1))
    named = base.where(F.size("spans") > 0).dropDuplicates(["k1", "k2"])
    names = named.select("k1", "k2", F.explode(F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))).alias("entity"))
    bits = lambda share: F.log2(share / (F.col("held") / F.lit(total)))
    # a term's share is 1 at most and its documents with the entity are no more than the entity's
    held = (names.groupBy("entity").agg(F.count("*").alias("held"))
            .where((F.col("held") >= min_docs) & (bits(F.lit(1.0)) >= min_bits)))
    names = stage(names.join(held, "entity"), "pii-names")
    words = stage(named.join(names.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
                  .select("k1", "k2", F.explode("words").alias("term")), "pii-words")
    seen = (docs.select(F.explode(words_of(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("term"))
            .groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= min_docs)
            .join(words.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs), "term", "left_semi"))
    share = F.least(F.col("both") / F.col("df"), F.lit(1.0))
    return (words.join(seen, "term").join(names, ["k1", "k2"]).where(F.col("held") >= F.col("df") * min_share)
            .groupBy("entity", "term", "df", "held").agg(F.count("*").alias("both")).where(F.col("both") >= min_docs)
            .select("entity", "term", share.alias("share"), bits(share).alias("bits"))
            .where((F.col("share") >= min_share) & (F.col("bits") >= min_bits)))


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """k1, k2, extra: the places of the terms in all documents."""
    rows = row_keys(text_of(docs)).select("k1", "k2", "text")
    holding = (rows.select("k1", "k2", F.explode(words_of(F.col("text"))).alias("term")).join(terms, "term", "left_semi")
               .groupBy("k1", "k2").agg(F.collect_set("term").alias("terms")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>").alias("out"))

    def step(acc, piece):
        end = acc["at"] + F.length(piece)
        span = F.struct(acc["at"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.array_contains("terms", F.lower(piece)), F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    holding = stage(holding, "pii-holding")
    # keys alone first: a small table, so that only the texts concerned are shuffled
    texts = stage(rows.join(stage(holding.select("k1", "k2"), "pii-keys"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]), "pii-texts")
    pieces = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    return (texts.join(holding, ["k1", "k2"])
            .select("k1", "k2", F.aggregate(pieces, zero, step, lambda acc: acc["out"]).alias("extra")))


def whole_personal_data(docs: DataFrame) -> DataFrame:
    base = stage(base_spans(docs, context=0, words=True), "pii-base")
    terms = stage(whole_terms(docs, base).select("term").distinct(), "pii-terms")
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    rows = (base.select("doc_id", "k1", "k2", plain.alias("base")).join(term_places(docs, terms), ["k1", "k2"], "left")
            .select("doc_id", "k1", "k2", "base", F.coalesce("extra", none).alias("extra")))
    free = F.filter("extra", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    return rows.select("doc_id", "k1", "k2", "base", F.array_sort(F.concat(F.col("base"), free)).alias("spans"))


def personal_data(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, k1, k2, base and spans: arrays of (start, rank, kind, end),
    ``spans`` with the disclosed terms; ``whole``: found in whole documents,
    not in the contexts of base spans alone."""
    if whole:
        return whole_personal_data(docs)
    base = stage(base_spans(docs), "pii-base")
    held = base.where(F.size("spans") > 0)
    context = stage(context_terms(held.dropDuplicates(["k1", "k2"])), "pii-context")
    told = disclosed_terms(docs, base, context)
    extra = (context.join(told.select("entity", "term"), ["entity", "term"])
             .select("k1", "k2", F.struct(F.col("start"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), F.col("end")).alias("s"))
             .distinct().groupBy("k1", "k2").agg(F.collect_list("s").alias("extra")))
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    rows = held.join(extra, ["k1", "k2"], "left").select("doc_id", "k1", "k2", plain.alias("base"), F.coalesce("extra", none).alias("extra"))
    rest = base.where(F.size("spans") == 0).select("doc_id", "k1", "k2", plain.alias("base"), none.alias("extra"))
    return rows.unionByName(rest).select("doc_id", "k1", "k2", "base", F.array_sort(F.concat("base", "extra")).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text with every span replaced by its kind in angle brackets;
    of overlapping spans the first (then the longest) counts."""
    rows = row_keys(text_of(docs)).join(found.select("k1", "k2", "spans").dropDuplicates(["k1", "k2"]), ["k1", "k2"], "left")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def step(acc, s):
        piece = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(piece, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))).alias("out")))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    return rows.select("doc_id", F.aggregate(F.coalesce(order, F.array()), zero, step, rest).alias("text"))
