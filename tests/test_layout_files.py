"""Round trips through real files for the seven layouts (LAY, SRC, SNK)."""
import itertools
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.plans import pipelines as PL
from panelspark.sources import readers as R
from panelspark.sources import writers as W

DATES = ["2020-01-31", "2020-02-29", "2020-03-31"]
STOCKS = ["000001", "600614", "300750"]
FACTORS = ["ret", "size"]


def full_panel():
    rows = []
    for i, (d, s, f) in enumerate(itertools.product(DATES, STOCKS, FACTORS)):
        rows.append((d, s, f, float(i) + 0.5))
    return pd.DataFrame(rows, columns=["date", "stock", "factor", "value"])


def write_layout(tmp, layout, p):
    d = tmp / f"lay{layout}"
    d.mkdir()
    if layout == 1:
        for f, g in p.groupby("factor"):
            g.pivot(index="date", columns="stock", values="value").reset_index().to_csv(d / f"{f}.csv", index=False)
    elif layout == 2:
        for f, g in p.groupby("factor"):
            g[["stock", "date", "value"]].to_csv(d / f"{f}.csv", index=False)
    elif layout == 3:
        for s, g in p.groupby("stock"):
            g.pivot(index="date", columns="factor", values="value").reset_index().to_csv(d / f"{s}.csv", index=False)
    elif layout == 4:
        for s, g in p.groupby("stock"):
            g[["date", "factor", "value"]].to_csv(d / f"{s}.csv", index=False)
    elif layout == 5:
        for dt_, g in p.groupby("date"):
            g.pivot(index="factor", columns="stock", values="value").reset_index().to_csv(d / f"{dt_}.csv", index=False)
    elif layout == 6:
        for dt_, g in p.groupby("date"):
            g[["stock", "factor", "value"]].to_csv(d / f"{dt_}.csv", index=False)
    elif layout == 7:
        w = p.pivot_table(index=["stock", "date"], columns="factor", values="value").reset_index()
        w.to_csv(d / "big.csv", index=False)
        return str(d / "big.csv")
    return str(d)


def as_set(df):
    return {(str(r.date), r.stock, r.factor, r.value) for r in df.collect()}


@pytest.mark.parametrize("layout", [1, 2, 3, 4, 5, 6, 7])
def test_all_layouts_give_one_panel(spark, tmp_path, layout):
    p = full_panel()
    path = write_layout(tmp_path, layout, p)
    roles = {"stock_col": "stock", "date_col": "date", "factor_cols": FACTORS} if layout == 7 else {}
    conv = PL.read_layout(spark, layout, path, "csv", **roles)
    want = {(r.date, r.stock, r.factor, r.value) for r in p.itertuples()}
    assert as_set(conv.panel.select("date", "stock", "factor", "value")) == want


def test_mixed_headers_kept_apart(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "A.csv").write_text("date,S1,S2\n2020-01-31,1,2\n")
    (d / "B.csv").write_text("date,S2,S3\n2020-01-31,20,30\n")
    conv = PL.read_layout(spark, 1, str(d), "csv")
    got = {(r.stock, r.factor, r.value) for r in conv.panel.collect()}
    assert got == {("S2", "A", 2.0), ("S2", "B", 20.0)}
    assert {r.value for r in conv.stocks.collect()} == {"S2"}


def test_null_cell_still_common(spark, tmp_path):
    d = tmp_path / "nulls"
    d.mkdir()
    (d / "A.csv").write_text("date,S1,S2\n2020-01-31,1,\n")
    (d / "B.csv").write_text("date,S1,S2\n2020-01-31,3,4\n")
    conv = PL.read_layout(spark, 1, str(d), "csv")
    got = {(r.stock, r.factor, r.value) for r in conv.panel.collect()}
    assert ("S2", "A", None) in got and ("S2", "B", 4.0) in got
    assert {r.value for r in conv.stocks.collect()} == {"S1", "S2"}


def test_layout5_union_stocks_no_reindex(spark, tmp_path):
    d = tmp_path / "l5"
    d.mkdir()
    (d / "20200131.csv").write_text("factor,S1,S2\nret,1,2\nsize,3,4\n")
    (d / "20200228.csv").write_text("factor,S2,S3\nret,5,6\n")
    conv = PL.read_layout(spark, 5, str(d), "csv")
    assert {r.value for r in conv.stocks.collect()} == {"S1", "S2", "S3"}
    assert {r.value for r in conv.factors.collect()} == {"ret"}
    assert {(str(r.date), r.stock) for r in conv.panel.collect()} == {
        ("2020-01-31", "S1"), ("2020-01-31", "S2"), ("2020-02-28", "S2"), ("2020-02-28", "S3")}


def test_convert_write_and_load_back(spark, tmp_path):
    p = full_panel()
    src = write_layout(tmp_path, 2, p.iloc[1:])          # one cell missing -> null after reindex
    out = str(tmp_path / "converted")
    PL.convert_files(spark, 2, src, out, "csv", "parquet")
    dates = sorted(os.listdir(out))
    assert [x for x in dates if x.startswith("date=")] == [f"date={d}" for d in DATES]
    man = [json.loads(line) for f in os.listdir(os.path.join(out, "_manifest")) if f.endswith(".json")
           for line in open(os.path.join(out, "_manifest", f))]
    assert man[0]["dates"] == DATES and man[0]["stocks"] == sorted(STOCKS) and man[0]["factors"] == FACTORS
    config = json.load(open(os.path.join(out, "config.json")))
    assert config["raw_data_format_type"] == 2 and config["dates"] == DATES
    long, axes = PL.load_converted(spark, out)
    rows = long.collect()
    assert len(rows) == len(DATES) * len(STOCKS) * len(FACTORS)
    assert sum(r.value is None for r in rows) == 1


def test_split_by_date_layout7(spark, tmp_path):
    p = full_panel()
    src = write_layout(tmp_path, 7, p)
    out = str(tmp_path / "split")
    PL.convert_files(spark, 7, src, out, "csv", "csv", stock_col="stock", date_col="date", factor_cols=FACTORS)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == len(DATES) * len(STOCKS)
    assert {r.date for r in back.select(F.col("date").cast("string").alias("date")).collect()} == set(DATES)


def test_feather_roundtrip_and_auto(spark, tmp_path):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 1.5).alias("x"), F.col("id").cast("string").alias("s"))
    out = str(tmp_path / "fe")
    W.write_feather(df.repartition(3), out)
    files = [f for f in os.listdir(out) if f.endswith(".feather")]
    assert len(files) == 3 and not [f for f in os.listdir(out) if f.endswith(".tmp")]
    back = R.read_feather(spark, out)
    assert back.count() == 1000 and back.agg(F.sum("x")).first()[0] == pytest.approx(1.5 * 999 * 1000 / 2)
    one = os.path.join(out, files[0])
    assert R.format_of(one) == "feather" and R.read_auto(spark, one).count() > 0
    with pytest.raises(ValueError):
        R.format_of("/x/data.tar.gz")


def test_keyed_folder_stems(spark, tmp_path):
    d = tmp_path / "stems"
    d.mkdir()
    (d / "a.b.csv").write_text("x\n1\n")
    first = R.read_keyed_folder(spark, str(d), "csv", rule="first_dot").first().file_key
    last = R.read_keyed_folder(spark, str(d), "csv", rule="last_ext").first().file_key
    assert (first, last) == ("a", "a.b")
