"""Holdings chain through files (SRC-7, HLD-1..13, SNK-6..8)."""
import os

from pyspark.sql import functions as F

from panelspark.operators import holdings as H
from panelspark.plans import pipelines as PL
from panelspark.sources import readers as R

HEADER = "ShareHolderID,SystematicsID,FundID,CategoryCode,ShareHolderName,Symbol,IndustryCode,IndustryName,EndDate,Holdshares\n"


def write_filings(tmp):
    d = tmp / "raw"
    d.mkdir()
    (d / "2019.csv").write_text(HEADER +
        "H1,s1,f1,c1,Fund One,000001,,,2019-12-31,100\n"        # winner lacks industry -> symbol dropped
        "H1,s9,f9,c9,Renamed,000002,I2,Bank,2019-12-31,300\n"
        "H1,s1,f1,c1,Fund One,600614,I3,Steel,2019-12-31,300\n"  # tie with 000002: symbol order
        "H2,s2,f2,c2,Fund Two,000001,I1,Tech,2019-12-31,x\n"      # bad text -> dropped
        "H2,s2,f2,c2,Fund Two,000002,I2,Bank,2019-12-31,-5\n"     # negative -> dropped
        "H2,s2,f2,c2,Fund Two,000003,I3,Steel,2020-03-31,7\n")
    (d / "2020.csv").write_text(HEADER +
        "H1,s1,f1,c1,Fund One,000001,I1,Tech,2020-03-31,5\n"
        "H1,s1,f1,c1,Fund One,000001,I1,Tech,2019-12-31,50\n"   # same basket again from a later file
        "H3,s3,f3,c3,Fund Three,000004,I4,Oil,2020-03-31,1\n")
    return str(d)


def test_pipeline_with_files(spark, tmp_path):
    raw = write_filings(tmp_path)
    static, out = str(tmp_path / "static"), str(tmp_path / "out")
    holders, industries, baskets = PL.run_holdings(spark, raw, static, out)
    h = {r.ShareHolderID: r.ShareHolderName for r in holders.collect()}
    assert h == {"H1": "Fund One", "H2": "Fund Two", "H3": "Fund Three"}     # first row wins
    ind = {r.Symbol for r in industries.collect()}
    assert "000001" not in ind and {"000002", "600614", "000003", "000004"} <= ind
    got = {(r.ShareHolderID, str(r.EndDate)): r.Holdings for r in baskets.collect()}
    assert got[("H1", "2019-12-31")] == "[000002, 600614, 000001, 000001]"
    assert ("H2", "2019-12-31") not in got and got[("H2", "2020-03-31")] == "[000003]"
    assert os.path.isdir(os.path.join(static, "shareholders.csv"))
    back = spark.read.option("header", True).csv(out)
    assert back.count() == len(got)
    stat = spark.read.option("header", True).csv(os.path.join(static, "stock_industries.csv"))
    assert stat.count() == len(ind)


def test_per_holder_export_and_stack(spark, tmp_path):
    raw = write_filings(tmp_path)
    _, _, baskets = PL.run_holdings(spark, raw, str(tmp_path / "st"), str(tmp_path / "ph"), per_holder=True)
    dirs = sorted(x for x in os.listdir(tmp_path / "ph") if x.startswith("ShareHolderID="))
    assert dirs == ["ShareHolderID=H1", "ShareHolderID=H2", "ShareHolderID=H3"]
    # the reference's per-holder files: <holder>.csv with EndDate, Holdings
    flat = tmp_path / "flat"
    flat.mkdir()
    for r in baskets.orderBy("ShareHolderID", "EndDate").collect():
        f = flat / f"{r.ShareHolderID}.csv"
        if not f.exists():
            f.write_text("EndDate,Holdings\n")
        with open(f, "a") as fh:
            fh.write(f'{r.EndDate},"{r.Holdings}"\n')
    stacked = PL.stack_holder_files(spark, str(flat))
    assert stacked.columns[0] == "ShareHolderID" and stacked.count() == baskets.count()


def test_merge_size_cap_keeps_every_row(spark, tmp_path):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("ShareHolderID"),
                                     F.lit("2020-03-31").alias("EndDate"),
                                     F.concat(F.lit("["), F.lit("000001, 000002, "), F.col("id").cast("string"),
                                              F.lit("]")).alias("Holdings"))
    out = str(tmp_path / "merged")
    per_file = PL.merge_baskets(df, out, max_file_size_mb=0.02, filter_func=lambda d: H.filter_holdings(d, 3))
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) > 1
    sizes = [os.path.getsize(os.path.join(out, f)) for f in files]
    assert max(sizes) < 0.02 * 1024 * 1024 * 1.5
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 5000 and back.select("ShareHolderID").distinct().count() == 5000
    assert per_file > 0


def test_bad_end_date_raises(spark):
    df = spark.createDataFrame([("H1", "2020/03/31")], "ShareHolderID string, EndDate string")
    try:
        H.parse_end_date(df).collect()
        raised = False
    except Exception as e:  # noqa: BLE001
        raised = "bad EndDate" in str(e)
    assert raised


def test_filings_row_order_first_wins_across_files(spark, tmp_path):
    raw = write_filings(tmp_path)
    f = R.read_filings(spark, raw)
    # 2019.csv is read before 2020.csv for first-wins: H1's first row is in 2019.csv
    dim = {r.ShareHolderID: r.SystematicsID for r in H.holder_dimension(f).collect()}
    assert dim["H1"] == "s1"


def test_training_pipeline_from_files(spark, tmp_path):
    merged = tmp_path / "merged"
    merged.mkdir()
    (merged / "merged_0.csv").write_text("ShareHolderID,EndDate,Holdings\n"
                                         'H1,2020-03-31,"[1, 600614, 3]"\nH2,2020-03-31,"[600614, 3]"\nH3,2020-03-31,bad\n')
    (merged / "merged_1.csv").write_text("ShareHolderID,EndDate,Holdings\n" + 'H4,2020-06-30,"[3]"\n')
    sent = PL.training_inputs(spark, str(merged))
    assert sent.count() == 3                                  # the bad row is rejected
    vocab, rows = PL.training_set(sent, max_length=6, batch_size=2)
    got = rows.collect()
    assert len(got) == 3 and all(len(r.input_ids) == 6 for r in got)
    assert sorted(r.batch_id for r in got) == [0, 0, 1]
    offsets, indexed = PL.dataset_index(spark, str(merged))
    off = {r.file_name: (r.n_rows, r.offset) for r in offsets.collect()}
    assert off == {"merged_0.csv": (3, 0), "merged_1.csv": (1, 3)}
    assert sorted(r.idx for r in indexed.collect()) == [0, 1, 2, 3]
