"""Corpus pipeline: documents -> packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet to the shared
folder and reads them back as the next stage's docs.

1. toxicity: rows predicted toxic go (learnt from labelled rows that are not
   held out).
2. line_dedup: repeated multi-line chunks go from the texts; n_chars follows.
3. near_dedup: of each group of near copies (five-word shingles, similarity
   0.8 or more) the document of smallest id stays.
4. decontamination: documents that hold a benchmark passage go.
5. packing: the tokenised rest in sequences of at most 2048 tokens.

Null texts count as empty and are kept by the filters; rows equal in id and
text are one document to near_dedup; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.llm import decontaminate, line_dedup, minhash, packing, toxicity
from tesoro.llm.common import stage, table


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.keep_civil(docs, model)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(docs, counts=False)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", civil),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Tokens, votes and signatures can't be expressed in SQL; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
