"""Folders whose files carry their own headers; wide files and Feather files over several tasks."""
import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.plans import pipelines as PL
from panelspark.plans.inspect import python_nodes
from panelspark.sources import feather, folders
from panelspark.sources import readers as R
from panelspark.sources import writers as W


def cells(df):
    return sorted((r.file_key, r.row_label, r.col_label, r.value) for r in df.collect())


def store(frame, path, fmt):
    if fmt == "csv":
        frame.to_csv(path, index=False)
    elif fmt == "parquet":
        frame.to_parquet(path, index=False)
    else:
        frame.to_feather(path)


@pytest.mark.parametrize("fmt", ["csv", "parquet", "feather"])
def test_three_headers_in_one_folder(spark, tmp_path, fmt):
    """Roles by position are each file's own third column; by name, each file's own place."""
    frames = {"ret": {"stock": ["a", "b"], "date": ["2020-01-31"] * 2, "ret": [1.0, 2.0]},
              "size": {"stock": ["a", "b"], "date": ["2020-01-31"] * 2, "size": [3.0, 4.0]},
              "exch": {"stock": ["a", "b"], "date": ["2020-01-31"] * 2, "note": ["N", "Q"], "more": [7, 8]}}
    for k, f in frames.items():
        store(pd.DataFrame(f), tmp_path / f"{k}.{fmt}", fmt)
    conv = PL.read_layout(spark, 2, str(tmp_path), fmt)
    got = {(r.stock, r.factor): (r.value, r.value_text) for r in conv.panel.collect()}
    assert {k: v[0] for k, v in got.items()} == {("a", "ret"): 1.0, ("b", "ret"): 2.0, ("a", "size"): 3.0, ("b", "size"): 4.0,
                                                 ("a", "exch"): None, ("b", "exch"): None}
    assert got["a", "exch"][1] == "N"
    other = tmp_path / "named"
    other.mkdir()
    store(pd.DataFrame({"v": [1.5], "d": ["2020-01-31"], "s": ["a"]}), other / f"x.{fmt}", fmt)
    store(pd.DataFrame({"s": ["a"], "v": [2.5], "d": ["2020-01-31"]}), other / f"y.{fmt}", fmt)
    conv = PL.read_layout(spark, 2, str(other), fmt, stock_col="s", date_col="d", value_col="v")
    assert {(r.factor, r.value) for r in conv.panel.collect()} == {("x", 1.5), ("y", 2.5)}
    store(pd.DataFrame({"s": ["a"], "w": [2.5], "d": ["2020-01-31"]}), other / f"z.{fmt}", fmt)
    with pytest.raises(Exception, match="not in"):
        folders.keyed_roles(spark, str(other), fmt, {"value": "v"}).collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet", "feather"])
def test_keyed_table_matches_names(spark, tmp_path, fmt):
    store(pd.DataFrame({"a": ["1"], "b": ["2"]}), tmp_path / f"x.{fmt}", fmt)
    store(pd.DataFrame({"b": ["3"], "c": ["4"]}), tmp_path / f"y.{fmt}", fmt)
    got = {r.file_key: (r.a, r.b, r.c) for r in R.read_keyed_folder(spark, str(tmp_path), fmt).collect()}
    assert got == {"x": ("1", "2", None), "y": (None, "3", "4")}


def test_wide_csv_spans_tasks_and_keeps_quotes(spark, tmp_path):
    names = [f"S{i}" for i in range(40)]
    lines = ["date," + ",".join(names)] + [f"d{k}," + ",".join(str(k * 100 + i) if (k + i) % 7 else "" for i in range(40)) for k in range(400)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "small.csv").write_text('\ufeffdate,"S,1","say ""hi"""\r\nd0,"1,5","x ""y"""\r\nd1,,2\r\n\r\nd2,3\r\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        df = R.read_wide_cells(spark, str(tmp_path), "csv")
        assert python_nodes(df) == []
        tasks = df.filter("file_key = 'big'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 3
        got = cells(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [("big", f"d{k}", f"S{i}", str(k * 100 + i) if (k + i) % 7 else None) for k in range(400) for i in range(40)]
    want += [("small", "d0", "S,1", "1,5"), ("small", "d0", 'say "hi"', 'x "y"'), ("small", "d1", "S,1", None), ("small", "d1", 'say "hi"', "2"),
             ("small", "d2", "S,1", "3"), ("small", "d2", 'say "hi"', None)]
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2])) or sorted(got, key=str) == sorted(want, key=str)
    (tmp_path / "bad.csv").write_text("date,S1\nd0,1,2\n")
    with pytest.raises(Exception, match="more fields than its header"):
        R.read_wide_cells(spark, str(tmp_path), "csv").collect()


@pytest.mark.parametrize("fmt", ["parquet", "feather"])
def test_wide_files_with_other_headers(spark, tmp_path, fmt):
    day = pd.to_datetime(["2020-01-31", "2020-02-29"]).astype("datetime64[us]")
    store(pd.DataFrame({"date": day, "S.1": [1.5, None], "S2": [2, 3]}), tmp_path / f"ret.{fmt}", fmt)
    store(pd.DataFrame({"date": ["2020-01-31"], "S2": ["N"], "S3": ["Q"]}), tmp_path / f"exch.{fmt}", fmt)
    df = R.read_wide_cells(spark, str(tmp_path), fmt)
    got = {(r.file_key, r.row_label, r.col_label): r.value for r in df.collect()}
    assert got.keys() == {("ret", d, c) for d in ("2020-01-31", "2020-02-29") for c in ("S.1", "S2")} | {("exch", "2020-01-31", c) for c in ("S2", "S3")}
    assert float(got["ret", "2020-01-31", "S.1"]) == 1.5 and got["ret", "2020-02-29", "S.1"] is None
    assert got["exch", "2020-01-31", "S3"] == "Q" and float(got["ret", "2020-02-29", "S2"]) == 3
    if fmt == "parquet":
        assert python_nodes(df) == []


def test_feather_by_record_batch(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.feather as pf
    import pyarrow.ipc as ipc
    path = str(tmp_path / "one.feather")
    with ipc.new_file(path, pa.schema([("x", pa.int64()), ("s", pa.string())])) as out:
        for k in range(3):
            out.write_batch(pa.record_batch({"x": pa.array(range(k * 10, k * 10 + 10)), "s": pa.array([str(k)] * 10)}))
    monkeypatch.setattr(feather, "RANGE_BYTES", 1)
    df = R.read_feather(spark, path)
    assert df.rdd.getNumPartitions() == 3 and df.agg(F.sum("x")).first()[0] == sum(range(30))
    pf.write_feather(pa.table({"s": ["z"], "y": [1.5]}), str(tmp_path / "two.feather"))
    pf.write_feather(pa.table({"x": [7]}), str(tmp_path / "old.feather"), version=1)
    both = {(r.file_key, r.x, r.s, r.y) for r in R.read_feather(spark, str(tmp_path), key_rule="first_dot").collect()}
    assert ("two", None, "z", 1.5) in both and ("old", 7, None, None) in both and len(both) == 32


@pytest.mark.parametrize("fmt", ["parquet", "csv", "feather"])
def test_a_text_factor_is_text_in_every_cell(spark, tmp_path, fmt):
    big = tmp_path / "big.csv"
    big.write_text("permno,date,code,ret\n10,2020-01-31,A01,0.5\n11,2020-01-31,0101,1\n12,2020-01-31,1d,\n")
    out = str(tmp_path / "out")
    PL.convert_files(spark, 7, str(big), out, "csv", fmt, stock_col="permno", date_col="date", factor_cols=["code", "ret"])
    got = {(r.stock, r.factor): (r.value, r.value_text) for r in PL.load_converted(spark, out, fmt)[0].collect()}
    assert got == {("10", "code"): (None, "A01"), ("11", "code"): (None, "0101"), ("12", "code"): (None, "1d"),
                   ("10", "ret"): (0.5, None), ("11", "ret"): (1.0, None), ("12", "ret"): (None, None)}
    long = PL.read_layout(spark, 7, str(big), "csv", stock_col="permno", date_col="date", factor_cols=["code", "ret"]).panel
    assert {r.value_text for r in long.filter("factor = 'code'").collect()} == {"A01", "0101", "1d"}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_more_factors_than_columns(spark, tmp_path, fmt):
    """Layout 4 with 12,000 factors: packed as maps, no factor list on the driver."""
    d = tmp_path / "in"
    d.mkdir()
    for s in ("a", "b"):
        (d / f"{s}.csv").write_text("date,factor,value\n" + "".join(f"2020-01-31,f{i},{i if i % 100 else 'T' + str(i)}\n" for i in range(12_000)))
    out = str(tmp_path / "out")
    conv = PL.convert_files(spark, 4, str(d), out, "csv", fmt)
    assert conv.factors.count() == 12_000
    got = {(r.stock, r.factor): (r.value, r.value_text) for r in PL.load_converted(spark, out, fmt)[0].collect()}
    want = {(s, f"f{i}"): (float(i), None) if i % 100 else (None, f"T{i}") for s in "ab" for i in range(12_000)}
    assert got == want


def test_merge_is_cut_by_bytes_in_order(spark, tmp_path):
    cap = 40_000
    rows = [(f"{i:05d}", "x" * 20) for i in range(4000)] + [("02000a", "y" * (cap * 3 // 10))]
    df = spark.createDataFrame(rows, "k string, v string").repartition(7)
    for name in ("one", "two"):
        n = W.write_merged(df, str(tmp_path / name), cap / 1024 / 1024, order=["k"])
    texts = [[p.read_bytes() for p in sorted((tmp_path / name).glob("part-*"))] for name in ("one", "two")]
    assert texts[0] == texts[1] and len(texts[0]) == n > 2
    longest = max(len(",".join(r)) for r in rows) + 1
    assert all(len(t) <= cap + longest + len("k,v\n") for t in texts[0]) and all(len(t) >= cap * 0.6 for t in texts[0][:-1])
    keys = [line.split(b",")[0].decode() for t in texts[0] for line in t.splitlines()[1:]]
    assert keys == sorted(k for k, _ in rows)


def test_one_date_spans_tasks(spark):
    from panelspark.operators import panel as P
    dates = spark.createDataFrame([(dt.date(2020, 1, 31),)], "value date")
    stocks = spark.range(5000).select(F.format_string("%05d", "id").alias("value"))
    panel = stocks.filter("value % 2 = 0").select(F.lit(dt.date(2020, 1, 31)).alias("date"), F.col("value").alias("stock"), F.lit("f").alias("factor"),
                                                  F.col("value").cast("double").alias("value"))
    wide = P.dense_cross_section(panel, ["f"], dates, stocks, stocks_per_task=400)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Union")]
    assert len({r.p for r in wide.select("stock", "f", F.spark_partition_id().alias("p")).collect()}) > 3
    got = {r.stock: r.f for r in wide.collect()}
    assert got == {f"{i:05d}": None if i % 2 else float(i) for i in range(5000)}
    assert {r.stock: r.f for r in P.dense_cross_section(panel, ["f"], dates, stocks, max_broadcast_rows=1, stocks_per_task=400).collect()} == got
