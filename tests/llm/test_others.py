"""OP 2, 3, 8, 10 and the pipeline."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from panelspark.llm import ann, language, licences, shards
from panelspark.llm.common import stage
from tests.llm.helpers import components, edge_docs, fingerprint, stripped

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def test_shards_match_the_mixture(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = shards.interleave(df, n_shards=16).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 1000 and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    total = Counter(r.source for r in got)
    share = Counter((r.shard, r.source) for r in got)
    assert all(abs(share[s, src] - n * sizes[s] / 1000) <= 2 for s in range(16) for src, n in total.items())
    again = {(r.doc_id, r.shard, r.slot) for r in shards.interleave(df.repartition(5), n_shards=16).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in got}


def test_shards_follow_the_plain_definition(spark):
    import hashlib
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    by = defaultdict(list)
    for r in docs:
        by[r.source].append((hashlib.md5(f"{shards.SEED}:{r.doc_id}".encode()).hexdigest(), r.doc_id))
    line = sorted(((2 * k + 1) / (2.0 * len(v)), src, h, d) for src, v in by.items() for k, (h, d) in enumerate(sorted(v)))
    want = {d: (i * 16) // len(line) for i, (_, _, _, d) in enumerate(line)}
    got = shards.op2_interleave(spark, SF).collect()
    assert {r.doc_id: r.shard for r in got} == want
    text = {r.doc_id: (r.text or "").encode() for r in docs}
    assert all((r["size"], r.text_crc32, r.law) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "rows") for r in got)


def test_shards_of_edges(spark):
    df = edge_docs(spark).withColumnRenamed("score", "source")
    got = shards.interleave(df, n_shards=3)
    assert got.count() == df.count() and got.columns.count("shard") == 1
    assert shards.interleave(df.limit(0), n_shards=3).count() == 0


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()}
    got = language.op3_language(spark, SF2).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98


def test_language_spans_and_edges(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    model = language.train(docs, "text", "lang", "doc_id", ~language.held_out())
    en = " ".join(docs.filter("lang = 'en' and n_chars > 800").first().text.split()[:80])
    fr = " ".join(docs.filter("lang = 'fr' and n_chars > 800").first().text.split()[:60])
    df = spark.createDataFrame([(1, f"{en} 12 ! {fr}"), (2, None), (3, ""), (4, "12 !"), (5, "Привет мир"), (None, fr)], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(df, model, keep=["doc_id"]).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "fr"] and abs(got[1].spans[1].first_word - 81) <= 3
    assert sum(s.words for s in got[1].spans) == 142
    assert all((got[k].lang_pred, got[k].score, got[k].spans) == ("und", 0.0, []) for k in (2, 3, 4))
    assert got[None].lang_pred == "fr" and got[5].lang_pred in model.langs
    edge = edge_docs(spark)
    assert language.identify(edge, model, keep=["doc_id", "text_", "row_"]).count() == edge.count()
    assert language.identify(edge.limit(0), model).count() == 0
    assert language.train(docs.limit(0), "text", "lang", "doc_id", ~language.held_out()) is None
    assert {r.lang_pred for r in language.identify(edge, None).collect()} == {"und"}


def test_viterbi_equals_the_plain_recursion():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(50, 3)).astype(np.float32) * 4
    sizes = [0, 1, 7, 30, 2, 0, 12]
    word = rng.integers(0, 50, sum(sizes))
    offsets = np.cumsum([0, *sizes])
    got = language.viterbi(scores, word, offsets, 3.0)
    for a, b in zip(offsets, offsets[1:]):
        if a == b:
            continue
        s = scores[word[a:b]].astype(float)
        v, back = s[0], []
        for t in range(1, b - a):
            step = v[:, None] - 3.0 * (1 - np.eye(3))
            back.append(step.argmax(axis=0))
            v = step.max(axis=0) + s[t]
        state = [int(v.argmax())]
        for k in back[::-1]:
            state.append(int(k[state[-1]]))
        assert got[a:b].tolist() == state[::-1]


def test_script_narrows_candidates(spark):
    rows = [(i, "привет мир как дела", "ru") for i in range(30)] + [(100 + i, "hello world how are you", "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df, "text", "lang", "doc_id", ~language.held_out())
    new = spark.createDataFrame([(1, "щука жаба"), (2, "zebra quilt")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.identify(new, model, keep=["doc_id"]).collect()} == {1: "ru", 2: "en"}


def test_neighbours_recall(spark):
    got = defaultdict(dict)
    for r in ann.op8_adaptive_scan(spark, "/root/testdata/sf0.1").collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        s[q] = -9
        fifth = np.sort(s)[-5]
        mine = [got[ids[q]][k] for k in range(1, 6)]
        assert all(abs(u[q] @ u[np.flatnonzero(ids == v)[0]] - sc) < 1e-12 for v, sc in mine)
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        hits += sum(sc >= fifth - 1e-12 for _, sc in mine)
        total += 5
    assert hits / total >= 0.9


def test_neighbours_of_edges(spark, monkeypatch):
    rows = [(0, [1.0, 0.0]), (50, None), (100, [0.0, 0.0]), (1, [float("nan"), 1.0]), (2, [1.0, None]), (3, [1.0, 1.0]), (3, [1.0, 1.0]),
            (None, [2.0, 0.0]), (150, [1.0, 0.5, 2.0]), (4, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in ann.nearest(df).orderBy("rank").collect()]
    half = round(2 ** -0.5, 12)
    assert got == [(0, 1, None, 1.0), (0, 2, 3, half), (0, 3, 3, half)]
    assert ann.nearest(df.limit(0)).count() == 0
    # a vector that a third of the rows hold, over several chunks and blocks
    monkeypatch.setattr(ann, "CHUNK", 40)
    rng = np.random.default_rng(1)
    many = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)]
    hot = ann.nearest(spark.createDataFrame(many, "vec_id long, embedding array<double>"), every=30).collect()
    assert [r.vec_id for r in sorted(hot, key=lambda r: r["rank"]) if r.query_id == 30] == [0, 3, 6, 9, 12]


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.train(spark.read.parquet(f"{SF2}/documents.parquet"))


def test_licences_of_the_table(spark, licence_model):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    lines = {"apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
             "gpl": "This work is licensed under the GNU General Public License, version 3."}
    held = {r.doc_id: {f for f, s in lines.items() if s in (r.text or "")} for r in docs.collect()}
    for r in licences.scan(docs, licence_model).collect():
        assert r.family in held[r.doc_id] if held[r.doc_id] else r.family == "unknown"


def test_licence_changes_and_edges(spark, licence_model):
    df = spark.createDataFrame([
        (0, "intro\nThis program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License\nend"),
        (1, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        (2, "the license to kill is granted by the public"), (3, "released into the wild under the stars"),
        (4, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!")], "doc_id long, text string")
    got = {r.doc_id: (r.family, r.paragraph) for r in licences.scan(df, licence_model).collect()}
    assert got == {0: ("gpl", 1), 1: ("mit", 0), 2: ("unknown", None), 3: ("unknown", None), 4: ("apache", 0)}
    edge = edge_docs(spark)
    assert [r.family for r in licences.scan(edge, licence_model).collect()] == ["unknown"] * edge.count()
    assert licences.scan(edge.limit(0), licence_model).count() == 0


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(9001, "12 ! 34", None, "s", 7), (9002, None, "en", None, None), (9003, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(junk)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "repeated_strings", "packing"]
    out, tables = docs, []
    for _, step in corpus_pipeline.STAGES:
        out = stage(step(spark, out, SF), "test-pipeline")
        tables.append(out)
    a, b, c, d = tables
    assert a.columns == b.columns == c.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in a.collect()}
    assert kept == {k for k, t in text.items() if any(ch.isalpha() for ch in t or "")}
    order = sorted(kept)
    first = components([fingerprint(text[k]) for k in order])
    assert sorted(r.doc_id for r in b.collect()) == sorted({order[i] for i in first})
    left = sorted(r.doc_id for r in b.collect())
    want = dict(zip(left, stripped([text[k] for k in left], 400, corpus_pipeline.PASSAGE)))
    cut = {r.doc_id: r for r in c.collect()}
    assert {k: r.text for k, r in cut.items()} == {k: t for k, t in want.items() if t.strip(" ") or t == text[k]}
    assert all(r.n_chars == len(r.text) for r in cut.values()) and any(want[k] != text[k] for k in left)
    assert {r.doc_id for r in d.collect()} == set(cut)
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_of_nothing(spark):
    out = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        out = stage(step(spark, out, SF), "test-empty")
        assert out.count() == 0
