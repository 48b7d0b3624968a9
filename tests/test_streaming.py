"""Structured Streaming: incremental filing ingest and the loss report."""


from panelspark.streaming import ingest as S
from panelspark.plans import views as V

HEADER = "ShareHolderID,SystematicsID,FundID,CategoryCode,ShareHolderName,Symbol,IndustryCode,IndustryName,EndDate,Holdshares\n"


def test_ingest_filings_incremental(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "staged")
    raw.mkdir()
    ckpt = str(tmp_path / "ckpt")
    (raw / "2019.csv").write_text(HEADER + "H1,s1,f1,c1,One,000001,I1,Tech,2019-12-31,100\n"
                                           "H1,s1,f1,c1,One,000002,I2,Bank,2019-12-31,300\n")
    q = S.ingest_filings(spark, str(raw), table, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    (raw / "2020.csv").write_text(HEADER + "H1,s9,f9,c9,Renamed,000003,I3,Oil,2020-03-31,5\n")
    q = S.ingest_filings(spark, str(raw), table, ckpt)      # only the new file is read
    q.awaitTermination(120)
    staged = spark.read.parquet(table)
    assert staged.count() == 3 and staged.select("batch_id").distinct().count() == 2
    holders, _, baskets = S.staged_baskets(spark, table)
    assert holders.first().ShareHolderName == "One"        # first arrival wins
    got = {str(r.EndDate): r.Holdings for r in baskets.collect()}
    assert got == {"2019-12-31": "[000002, 000001]", "2020-03-31": "[000003]"}


def test_epoch_report_stream_matches_batch(spark, tmp_path):
    log = V.v_log(spark, "/root/testdata/sf0.001")
    src = str(tmp_path / "log")
    log.repartition(4).write.parquet(src)
    q = S.run_epoch_report(spark, src, "epoch long, step long, loss double", report_every=5,
                           query_name="er_test", checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r.epoch: (r.n_steps, round(r.loss_mean, 9)) for r in spark.sql("SELECT * FROM er_test").collect()}
    from panelspark.operators.stats import epoch_report
    want = {r.epoch: (r.n_steps, round(r.loss_mean, 9)) for r in epoch_report(log, 5).collect()}
    assert got == want and len(got) > 0
