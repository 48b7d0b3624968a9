"""Columns of the input with the names that the stages use themselves."""
from pyspark.sql import functions as F

import corpus_pipeline
from panelspark.llm.common import stage

CLASH = ("score", "lang_pred", "fit", "letters", "strange", "spans", "row_", "text_", "id_", "k1", "k2", "uid", "rank", "fingerprint",
         "kept_text_", "code", "ranges", "start", "n_tokens", "ids")


def test_stages_take_clashing_columns(spark):
    plain = out = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wide = out.select("*", *[F.lit("clash").alias(c) for c in CLASH])
    for name, step in corpus_pipeline.STAGES[:-1]:
        out, wide = stage(step(spark, out, ""), f"test-{name}"), stage(step(spark, wide, ""), f"test-wide-{name}")
        assert wide.columns == [*plain.columns, *CLASH]
        assert {tuple(r) for r in wide.select(*plain.columns).collect()} == {tuple(r) for r in out.collect()} != set()
        assert wide.filter(" or ".join(f"{c} <> 'clash'" for c in CLASH)).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, wide, "").count() == last(spark, out, "").count() > 0
