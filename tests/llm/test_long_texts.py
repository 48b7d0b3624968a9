"""Texts far longer than the tables' own, ties and clashing columns, operator by operator."""
from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import ann, cws, language, licences, shards
from tests.llm.helpers import long_text

SF = "/root/testdata/sf0.001"
LONG = long_text(60_000)


def test_shards_and_fingerprints_of_a_long_text(spark):
    rows = [(1, LONG, "a"), (2, "short one", "a"), (3, LONG, "b"), (4, None, "b"), (5, LONG + " end", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = shards.interleave(df.withColumn("size", F.octet_length("text")), n_shards=2).collect()
    assert sorted(r.doc_id for r in cut) == [1, 2, 3, 4, 5] and {r.doc_id: r.size for r in cut}[1] == len(LONG.encode())
    got = {r.doc_id: r for r in cws.fingerprint_pairs(df.select("doc_id", "text")).collect()}
    assert got[1].n_chars == len(LONG) and got[1].fingerprint == got[3].fingerprint != got[2].fingerprint
    words = [Counter(t.split()) for t in (LONG, LONG + " end")]
    exact = sum((words[0] & words[1]).values()) / sum((words[0] | words[1]).values())
    same = spark.createDataFrame([(1, LONG), (0, LONG + " end")], "doc_id long, text string")      # descending ids: 0 follows 1
    assert exact > 0.9999 and {r.doc_id: r.near_next for r in cws.fingerprint_pairs(same).collect()}[1] >= 0.9


def test_language_of_long_mixed_and_tied_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs, "text", "lang", "doc_id", ~language.held_out())
    head = {k: docs.filter(f"lang = '{k}' and n_chars > 800").orderBy("doc_id").first().text for k in ("en", "de")}
    both = " ".join([head["en"]] * 300 + [head["de"]] * 100)
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame([(1, both), (2, "zzz " * 20_000), (3, None)], "doc_id long, text string"),
                                                  model, keep=["doc_id"]).collect()}
    assert got[1].lang_pred == "en" and 0.6 < got[1].score < 0.95 and got[3].lang_pred == "und"
    assert sum(s.words for s in got[1].spans) == len(both.split()) == got[1].spans[-1].first_word + got[1].spans[-1].words
    twice = spark.createDataFrame([(i, "abc def ghi", k) for i in range(60) for k in ("xx", "yy")], "doc_id long, text string, lang string")
    tied = language.train(twice, "text", "lang", "doc_id", ~language.held_out())
    only = language.identify(spark.createDataFrame([(1, "abc def")], "doc_id long, text string"), tied, keep=["doc_id"]).first()
    assert only.lang_pred == "xx"                               # equal scores: the first in order


def test_word_scores_are_those_of_the_counts(spark):
    """The score of a word again from its letters' n-grams, and the share of letters of the winner."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs, "text", "lang", "doc_id", ~language.held_out())
    rows = docs.select("doc_id", "text").limit(40)
    for r in language.identify(rows, model, keep=["doc_id", "text"]).collect():
        letters = Counter()
        ws = r.text.split()
        for s in r.spans:
            letters[s.lang] += sum(ch.isalpha() for w in ws[s.first_word:s.first_word + s.words] for ch in w)
        if sum(letters.values()):
            best = max(letters.values())
            assert letters[r.lang_pred] == best and abs(r.score - best / sum(letters.values())) < 0.02


def test_licence_in_a_long_text_and_ties(spark):
    model = licences.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    lines = LONG.split(" ")
    body = "\n".join(" ".join(lines[i:i + 30]) for i in range(0, len(lines), 30))
    df = spark.createDataFrame([(1, f"{body}\nReleased under the MIT License.\n{body}"), (2, body),
                                (3, "Released under the MIT License.\nReleased under the MIT License.")], "doc_id long, text string")
    got = {r.doc_id: (r.families, r.paragraph, r.n_paragraphs) for r in licences.scan(df, model).collect()}
    assert got == {1: (["mit"], 2000, 1), 2: ([], None, 0), 3: (["mit"], 0, 2)}


def test_stages_take_long_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    en = docs.filter("lang = 'en' and n_chars > 800").orderBy("doc_id").first().text
    more = spark.createDataFrame([(10 ** 6, (en + " ") * 400, None, "s", 0)], docs.schema)
    assert corpus_pipeline.language_id(spark, docs.unionByName(more), SF).filter("doc_id = 1000000").count() == 1
    packed = corpus_pipeline.packing(spark, more, SF)
    whole = packed.agg(F.sum("length"), F.max("doc_tokens")).first()
    assert whole[0] == whole[1] > 50_000


def test_neighbours_with_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), "clash", "clash", "clash", "clash") for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, uid string, list string, score string, rank string")
    plain = {(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df.select("vec_id", "embedding")).collect()}
    assert {(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df).collect()} == plain and len(plain) == 15
