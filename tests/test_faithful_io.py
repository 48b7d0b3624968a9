"""Nothing is lost or altered on the way through files and keys."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelspark.functions.scalars import basket_text
from panelspark.operators import corpus as C
from panelspark.operators import embed as EM
from panelspark.operators import holdings as H
from panelspark.operators import layouts as L
from panelspark.operators import mlm as M
from panelspark.operators import panel as P
from panelspark.operators import stats as ST
from panelspark.plans import pipelines as PL
from panelspark.sources import readers as R
from panelspark.sources import writers as W

KEYS = ["ShareHolderID", "EndDate"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "feather"])
def test_text_factors_and_stock_codes_survive(spark, tmp_path, fmt):
    d = tmp_path / "in"
    d.mkdir()
    (d / "ret.csv").write_text("stock,date,value\n000001,2020-01-31,1.5\n000002,2020-01-31,2\n")
    (d / "exch.csv").write_text("stock,date,value\n000001,2020-01-31,N\n000002,2020-01-31,Q\n")
    out = str(tmp_path / f"out-{fmt}")
    PL.convert_files(spark, 2, str(d), out, "csv", fmt)
    long, _ = PL.load_converted(spark, out, fmt)
    got = {(r.stock, r.factor): (r.value, r.value_text) for r in long.collect()}
    assert got == {("000001", "ret"): (1.5, None), ("000002", "ret"): (2.0, None), ("000001", "exch"): (None, "N"), ("000002", "exch"): (None, "Q")}


def test_wide_file_text_and_layout7_text(spark, tmp_path):
    d = tmp_path / "wide"
    d.mkdir()
    (d / "ret.csv").write_text("date,S1,S2\n2020-01-31,1,\n")
    (d / "exch.csv").write_text("date,S1,S2\n2020-01-31,N,Q\n")
    conv = PL.read_layout(spark, 1, str(d), "csv", keep_text=True)
    row = W.cross_sections(conv).orderBy("stock").collect()
    assert [(r.stock, r.ret, r.exch) for r in row] == [("S1", 1.0, "N"), ("S2", None, "Q")]
    big = tmp_path / "big.csv"
    big.write_text("permno,date,primexch,ret\n10,2020-01-31,N,0.5\n11,2020-01-31,Q,x\n")
    out = str(tmp_path / "out7")
    PL.convert_files(spark, 7, str(big), out, "csv", "parquet", stock_col="permno", date_col="date", factor_cols=["primexch", "ret"])
    got = {(r.stock, r.factor): (r.value, r.value_text) for r in PL.load_converted(spark, out)[0].collect()}
    # a factor has one type over all its cells: "ret" holds a text, so its "0.5" is one too
    assert got == {("10", "primexch"): (None, "N"), ("11", "primexch"): (None, "Q"), ("10", "ret"): (None, "0.5"), ("11", "ret"): (None, "x")}


def test_duplicate_panel_keys_raise(spark):
    day = dt.date(2020, 1, 31)
    p = spark.createDataFrame([(day, "a", "f", 1.0), (day, "a", "f", 2.0)], "date date, stock string, factor string, value double")
    with pytest.raises(Exception, match="duplicate panel key"):
        P.cross_section(p, ["f"]).collect()
    with pytest.raises(Exception, match="duplicate panel key"):
        P.cross_section(p, ["f"] + [f"g{i}" for i in range(P.CONDITIONAL_PIVOT_MAX)]).collect()
    assert P.cross_section(p, ["f"], on_duplicate="max").first().f == 2.0


def test_layout7_takes_dates_and_timestamps(spark):
    t = spark.createDataFrame([("a", dt.datetime(2020, 1, 31), 1.0)], "s string, d timestamp, f double")
    assert L.layout7(t, "s", "d", ["f"])[1].first().date == dt.date(2020, 1, 31)


def test_dense_grid_above_the_broadcast_bound(spark):
    dates = spark.createDataFrame([(dt.date(2020, 1, 31),), (dt.date(2020, 2, 29),)], "value date")
    stocks = spark.createDataFrame([(s,) for s in "abc"], "value string")
    assert P.dense_grid(dates, stocks, max_broadcast_rows=1).count() == 6


def test_dense_cross_section_never_shuffles_the_grid(spark):
    dates = spark.range(30).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("value"))
    stocks = spark.range(50).select(F.col("id").cast("string").alias("value"))
    panel = dates.crossJoin(stocks.withColumnRenamed("value", "s")).select(
        F.col("value").alias("date"), F.col("s").alias("stock"), F.lit("f").alias("factor"), F.lit(1.0).alias("value"))
    wide = P.dense_cross_section(panel, ["f"], dates, stocks)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    head = plan[:plan.index("Union")]
    assert "Exchange" not in head
    assert wide.count() == 1500


def test_feather_overwrite_replaces_and_empty_reads_back(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(10)
    W.write_feather(df, path, "overwrite")
    W.write_feather(df, path, "overwrite")
    assert R.read_feather(spark, path).count() == 10
    W.write_feather(df, path, "append")
    assert R.read_feather(spark, path).count() == 20
    empty = str(tmp_path / "e")
    W.write_feather(df.limit(0), empty, "overwrite")
    assert R.read_feather(spark, empty).count() == 0


def sizes(path):
    return sorted(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))


def test_merge_fills_files_to_the_cap(spark, tmp_path):
    many = spark.range(40).repartition(40).select(F.col("id").cast("string").alias("a"))
    W.write_merged(many, str(tmp_path / "one"), 100)
    assert len(sizes(str(tmp_path / "one"))) == 1
    # short rows first, then long ones of three bytes a character
    mixed = spark.range(0, 22_000, 1, 4).select(
        F.when(F.col("id") < 12_000, F.lit("x")).otherwise(F.repeat(F.lit("股"), 100)).alias("a"))
    W.write_merged(mixed, str(tmp_path / "mixed"), 0.5)
    got = sizes(str(tmp_path / "mixed"))
    assert max(got) <= 1.5 * 0.5 * 1024 * 1024 and len(got) <= 8
    assert spark.read.option("header", True).csv(str(tmp_path / "mixed")).count() == 22_000


def test_vectors_keep_the_vocabulary_order(spark, tmp_path):
    path = str(tmp_path / "v")
    v = spark.createDataFrame([("z", [1.0], 0), ("a", [2.0], 1), ("m", [3.0], 2)], "token string, vector array<double>, index long")
    W.write_w2v_text(v, path)
    back = R.read_w2v_text(spark, path).orderBy("index").collect()
    assert [(r.token, list(r.vector)) for r in back] == [("z", [1.0]), ("a", [2.0]), ("m", [3.0])]
    matrix = EM.embedding_matrix(v.select("token", "index"), R.read_w2v_text(spark, path), join_on="token")
    assert [r.vector[0] for r in matrix.orderBy("index").limit(3).collect()] == [1.0, 2.0, 3.0]
    (tmp_path / "bad.txt").write_text("2 2\na 1 2\nb 1\n")
    with pytest.raises(Exception, match="another length"):
        R.read_w2v_text(spark, str(tmp_path / "bad.txt")).collect()
    W.write_vocab_json(v, str(tmp_path / "t2i"), str(tmp_path / "i2t"))
    assert [(x["index"], x["token"]) for x in W.read_json_lines(str(tmp_path / "i2t"))] == [(0, "z"), (1, "a"), (2, "m")]


def test_missing_vector_raises(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, index long")
    vec = spark.createDataFrame([("a", [1.0, 2.0])], "token string, vector array<double>")
    with pytest.raises(Exception, match="without a vector"):
        EM.embedding_matrix(vocab, vec, join_on="token").collect()


def test_two_rows_of_one_key_stay_two(spark):
    df = spark.createDataFrame([("h", "2020-01-31", "[1, 2]"), ("h", "2020-01-31", "[3]")], "ShareHolderID string, EndDate string, Holdings string")
    sent = C.sentences(df, "Holdings", keep=KEYS)
    vocab = C.vocabulary(sent)
    assert sorted(len(r.input_ids) for r in M.token_ids(sent, KEYS, vocab).collect()) == [3, 4]
    assert M.training_rows(sent, KEYS, vocab, max_length=5).count() == 2
    kept = C.subsample(sent, KEYS, sample=10.0).collect()
    assert sorted(tuple(r.tokens) for r in kept) == sorted(tuple(r.tokens) for r in sent.collect())


def test_subsample_with_a_marker_in_every_row_and_no_broadcast(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("ShareHolderID"), F.lit("d").alias("EndDate"),
                                 F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]")).alias("Holdings"))
    sent = C.sentences(df, "Holdings", keep=KEYS)
    a = {(r.ShareHolderID, tuple(r.tokens)) for r in C.subsample(sent, KEYS, sample=0.01).collect()}
    b = {(r.ShareHolderID, tuple(r.tokens)) for r in C.subsample(sent, KEYS, sample=0.01, max_broadcast=0).collect()}
    assert a == b and len(a) > 0


def test_running_variance_far_from_zero(spark):
    rows = [("g", i, 1e9 + (i % 3)) for i in range(60)] + [("h", 0, 5.0)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {(r.g, r.i): r for r in ST.running_summary(df, ["g"], ["i"], "v", num_partitions=7).collect()}
    for i in range(1, 60):
        x = [1e9 + k % 3 for k in range(i + 1)]
        mean = sum(k % 3 for k in range(i + 1)) / (i + 1)
        want = sum((k % 3 - mean) ** 2 for k in range(i + 1)) / (i + 1)
        assert abs(got["g", i].run_var - want) < 1e-6 and got["g", i].run_count == len(x)
    assert got["h", 0].run_count == 1


def test_share_text_and_basket_text(spark):
    df = spark.createDataFrame([("100d",), ("1e2",), ("7",), (" 8 ",), ("1f",), ("NaN",), (".5",), ("-3",)], "Holdshares string")
    assert sorted(r.Holdshares for r in H.clean_shares(df).collect()) == [0.5, 7.0, 8.0, 100.0]
    row = spark.range(1).select(basket_text(F.array(F.lit("1"), F.lit(None).cast("string"))).alias("t")).first()
    assert row.t == "[1, nan]"
