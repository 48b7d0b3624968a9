"""Corpus pipeline: language ID, near-duplicates, repeated strings, packing.

Each stage takes all that its predecessor kept (a table with the columns of
``documents``) and is written as Parquet before the next one reads it:

1. ``language_id``: documents whose language can't be told go: no letters, most
   letters of a script of no learned language, or letters that fit the learned
   languages worse than held-out documents do; the labels learned from are those
   of the stage's own input, held-out documents left aside to measure the fit;
2. ``near_duplicates``: of each SimHash component the row of the smallest id stays;
3. ``repeated_strings``: strings of 400 bytes and passages of ``PASSAGE`` words that
   occur more than once are cut out; documents with nothing left go; ``n_chars`` is that of the new text;
4. ``packing``: the rest as sequences of a power of two of tokens, by document.

``ORACLE_SQL`` is None: Viterbi, the trie join, the suffix arrays and the
tokenizer have no SQL form; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import language, pack, simhash, suffix_dedup
from panelspark.llm.common import stage

PASSAGE = 51               # words


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs, "text", "lang", "doc_id", ~language.held_out())
    if model is None:      # nothing to learn from: only texts without letters can be told apart
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return language.keep_known(docs, model, language.level(docs, model, "text", "lang", "doc_id", language.held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.strip_repeats(docs, words=PASSAGE)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
