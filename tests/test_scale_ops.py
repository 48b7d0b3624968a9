"""Skew-safe indexing, running statistics, masking and batching against
brute force on small fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import corpus as C
from panelspark.operators import indexing as I
from panelspark.operators import mlm as M
from panelspark.operators import stats as ST


def skewed(spark, n=3000):
    # one key holds about a third of all rows
    rng = np.random.default_rng(7)
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))
    pdf = pd.DataFrame({"k": keys.astype("int64"), "t": np.arange(n, dtype="int64")[::-1],
                        "x": np.round(rng.random(n) * 100, 2)})
    return pdf, spark.createDataFrame(pdf)


def test_global_index_total_order_under_skew(spark):
    pdf, df = skewed(spark)
    got = I.global_index(df, ["k", "t"], "idx", num_partitions=6).toPandas()
    want = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    want["idx"] = np.arange(len(want))
    m = got.merge(want, on=["k", "t"], suffixes=("", "_w"))
    assert len(m) == len(pdf) and (m["idx"] == m["idx_w"]).all()


def test_running_stats_match_pandas_under_skew(spark):
    pdf, df = skewed(spark)
    got = ST.running_summary(df, ["k"], ["t"], "x", ddof=1, num_partitions=6).toPandas()
    s = pdf.sort_values(["k", "t"])
    g = s.groupby("k")["x"]
    s = s.assign(c=g.cumcount() + 1, s=g.cumsum(), m=g.cumsum() / (g.cumcount() + 1),
                 v=g.expanding().var(ddof=1).reset_index(level=0, drop=True))
    m = got.merge(s, on=["k", "t"])
    assert len(m) == len(pdf)
    assert (m["run_count"] == m["c"]).all()
    assert np.allclose(m["run_sum"], m["s"]) and np.allclose(m["run_mean"], m["m"])
    ok = m["c"] >= 2
    assert np.allclose(m.loc[ok, "run_var"], m.loc[ok, "v"], rtol=1e-6)
    assert m.loc[~ok, "run_var"].isna().all()


def test_epoch_report_and_steps(spark):
    log = spark.createDataFrame([(e, s, float(e * 10 + s)) for e in range(4) for s in range(6)],
                                "epoch int, step int, loss double")
    r = {x.epoch: x for x in ST.epoch_report(log, report_every=2).collect()}
    assert set(r) == {0, 2}
    assert r[2].loss_mean == pytest.approx(22.5) and r[2].loss_std == pytest.approx(np.std(np.arange(6)))
    assert ST.every_nth_step(log, 3).count() == 8


def sentences(spark):
    rows = [(i, ["[CLS]"] + [f"{(i * 7 + j) % 40:06d}" for j in range(3 + i % 9)] + ["[SEP]"]) for i in range(300)]
    rows.append((999, ["[CLS]"] + [f"{j:06d}" for j in range(60)] + ["[SEP]"]))   # long row
    return spark.createDataFrame(rows, "rid int, tokens array<string>")


def test_vocabulary_order_and_specials(spark):
    sent = sentences(spark)
    v = C.vocabulary(sent).toPandas()
    core = v[v["raw"].notna()].sort_values("index")
    assert list(core["index"]) == list(range(len(core)))
    assert core["count"].is_monotonic_decreasing
    assert set(core.head(2)["token"]) == {"0[CLS]", "0[SEP]"}
    n = len(core)
    sp = v[v["raw"].isna()].set_index("token")["index"].to_dict()
    assert sp == {"[MASK]": n, "[PAD]": n + 1, "[UNK]": n + 2, "[CLS]": n + 3, "[SEP]": n + 4}
    C.check_vocab_size(C.vocabulary(sent), n + 5)
    with pytest.raises(ValueError):
        C.check_vocab_size(C.vocabulary(sent), n + 4)


def test_long_row_cut_no_sep_no_pad(spark):
    sent = sentences(spark)
    vocab = C.vocabulary(sent)
    info = M.vocab_info(vocab)
    r = M.training_rows(sent, ["rid"], vocab, max_length=50, mask_prob=0.0).filter("rid = 999").first()
    assert len(r.input_ids) == 50 and r.input_ids[0] == info["cls_id"]
    assert info["sep_id"] not in r.input_ids and info["pad_id"] not in r.input_ids
    assert r.attention_mask == [1] * 50 and set(r.labels) == {-100}


def test_masking_restores_inputs(spark):
    sent = sentences(spark)
    vocab = C.vocabulary(sent)
    info = M.vocab_info(vocab)
    clean = {r.rid: r.input_ids for r in M.training_rows(sent, ["rid"], vocab, max_length=20, mask_prob=0.0).collect()}
    masked = M.training_rows(sent, ["rid"], vocab, max_length=20, mask_prob=0.15, seed=3).collect()
    chosen = total = 0
    specials = {info[k] for k in ("cls_id", "sep_id", "mask_id", "pad_id", "unk_id")}
    for r in masked:
        base = clean[r.rid]
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 20
        for x0, x, lab in zip(base, r.input_ids, r.labels):
            if lab != -100:
                chosen += 1
                assert lab == x0 and x0 not in specials
            else:
                assert x == x0
            total += x0 not in specials
    assert 0.08 < chosen / total < 0.22
    again = {r.rid: r.input_ids for r in M.training_rows(sent, ["rid"], vocab, max_length=20, seed=3).collect()}
    assert again == {r.rid: r.input_ids for r in masked}          # seeded: same masks


def test_batches_hold_each_row_once(spark):
    sent = sentences(spark)
    b = M.shuffle_batches(sent.select("rid"), ["rid"], batch_size=32, seed=1, num_partitions=5).toPandas()
    assert sorted(b["sample_idx"]) == list(range(len(b)))
    assert b["rid"].is_unique
    sizes = b.groupby("batch_id").size().sort_index()
    assert list(sizes.index) == list(range(len(sizes)))
    assert (sizes.iloc[:-1] == 32).all() and sizes.iloc[-1] == (len(b) % 32 or 32)
    assert list(b.sort_values("sample_idx")["rid"]) != sorted(b["rid"])   # shuffled


def test_locate_global_index(spark):
    per_file = spark.createDataFrame([("b", 3), ("a", 2), ("c", 4)], "file_name string, n_rows long")
    off = M.file_offsets(per_file)
    idx = spark.range(0, 10).withColumnRenamed("id", "idx")
    got = {r.idx: (r.file_name, r.line) for r in M.locate(idx, off).collect()}
    assert got[0] == ("a", 0) and got[2] == ("b", 0) and got[5] == ("c", 0) and got[8] == ("c", 3)
    assert got[9] == (None, None)
    wide = {r.idx: (r.file_name, r.line) for r in M.locate(idx, off, max_buckets=2).collect()}
    assert wide == got                               # buckets of width 5 give the same answer


def test_locate_plan_is_equi_join(spark):
    from panelspark.plans.inspect import plan_text
    per_file = spark.createDataFrame([("a", 2), ("b", 3)], "file_name string, n_rows long")
    t = plan_text(M.locate(spark.range(0, 5).withColumnRenamed("id", "idx"), M.file_offsets(per_file)))
    assert "BroadcastHashJoin" in t and "NestedLoop" not in t


def test_subsample_keeps_rare_drops_frequent(spark):
    sent = sentences(spark)
    kept = C.subsample(sent, ["rid"], sample=1e-3, seed=5).collect()
    toks = [t for r in kept for t in r.tokens]
    assert toks.count("[CLS]") < 150          # frequent marker mostly dropped
    assert len(kept) > 0


def test_alias_last_wins_and_encode_decode(spark):
    alias = spark.createDataFrame([("000001", "Alpha", 1), ("000002", "Beta", 2), ("000003", "Alpha", 3)],
                                  "code string, name string, row_order int")
    n2c, c2n = C.alias_maps(alias)
    assert {r.name: r.code for r in n2c.collect()} == {"Alpha": "000003", "Beta": "000002"}
    sent = spark.createDataFrame([(1, ["[CLS]", "000003", "000002", "[SEP]"])], "rid int, tokens array<string>")
    vocab = C.vocabulary(sent)
    texts = spark.createDataFrame([("Alpha",), ("2",), ("Nope",)], "t string")
    ids = {r.t: r.id for r in C.encode(texts, "t", vocab, n2c).collect()}
    info = M.vocab_info(vocab)
    assert ids["Nope"] == info["unk_id"] and ids["Alpha"] != info["unk_id"] and ids["2"] != info["unk_id"]
    dec = C.decode(spark.createDataFrame([(ids["Alpha"],)], "id long"), "id", vocab, c2n, mode="name")
    assert dec.first().decoded == "Alpha"


def test_baskets_with_a_hot_holder(spark):
    """A third of all rows belong to one holder, most of them on one date."""
    from panelspark.operators import holdings as H
    rng = np.random.default_rng(11)
    n = 6000
    hot = rng.random(n) < 0.34
    holder = np.where(hot, 0, rng.integers(1, 200, n))
    date = np.where(hot & (rng.random(n) < 0.8), "2020-03-31", rng.choice(["2020-06-30", "2020-09-30"], n))
    pdf = pd.DataFrame({"h": holder.astype("int64"), "d": date, "s": [f"{x:06d}" for x in rng.integers(0, 500, n)],
                        "q": rng.integers(1, 50, n).astype("float64")})
    df = spark.createDataFrame(pdf)
    plain = {(r.h, r.d): r.symbols for r in H.baskets(df, "h", "d", "s", "q").collect()}
    salted = {(r.h, r.d): r.symbols for r in H.baskets(df, "h", "d", "s", "q", salt_buckets=8).collect()}
    assert plain == salted
    copies = df.unionByName(df.filter("h = 0")).unionByName(df.filter("h = 0"))   # the hot holder three times over
    c_plain = {(r.h, r.d): r.symbols for r in H.baskets(copies, "h", "d", "s", "q").collect()}
    c_coll = {(r.h, r.d): r.symbols for r in H.baskets(copies, "h", "d", "s", "q", collapse_copies=True).collect()}
    assert c_plain == c_coll and len(c_plain[(0, "2020-03-31")]) == 3 * len(plain[(0, "2020-03-31")])
    want = {k: list(g.sort_values(["q", "s"], ascending=[False, True])["s"]) for k, g in pdf.groupby(["h", "d"])}
    assert plain == want
    items = H.basket_items(df, "h", "d", "s", "q", num_partitions=6).toPandas()
    rebuilt = {k: list(g.sort_values("rank")["s"]) for k, g in items.groupby(["h", "d"])}
    assert rebuilt == want
    assert (items.groupby(["h", "d"])["rank"].apply(lambda r: sorted(r) == list(range(len(r))))).all()


def test_heavy_pairs_are_ranked_over_several_tasks(spark, monkeypatch):
    """A pair with 30 % of the rows: found by counting, cut into sorted runs, equal to the plain baskets."""
    import random
    from panelspark.operators import holdings as H
    rng = random.Random(1)
    rows = [("hot" if k % 10 < 3 else f"h{k % 50}", "2020-01-31", f"{rng.randrange(400):04d}" if k % 97 else None,
             float(rng.randrange(50)) if k % 89 else None) for k in range(6000)]
    df = spark.createDataFrame(rows, "holder string, date string, symbol string, shares double")
    want = {(r.holder, r.date): r.symbols for r in H.baskets(df, "holder", "date", "symbol", "shares").collect()}
    monkeypatch.setattr(H, "HEAVY_ROWS", 1000)
    monkeypatch.setattr(H, "HEAVY_BYTES", 0)
    got = {(r.holder, r.date): r.symbols for r in H.baskets(df, "holder", "date", "symbol", "shares").collect()}
    assert got == want and len(got["hot", "2020-01-31"]) == 1800
    assert [r.holder for r in H.heavy_pairs(df, "holder", "date").collect()] == ["hot"]
    from panelspark.operators.indexing import sorted_tagged
    from pyspark.sql import functions as F
    per = sorted_tagged(df.filter("holder = 'hot'"), [F.desc("shares"), "symbol"], partition_first=["holder", "date"]).groupBy("_pid").count().collect()
    assert len(per) > 3 and max(r["count"] for r in per) < 3 * 1800 / len(per)


def test_rows_are_named_by_content(spark):
    """Ids and subsamples are equal under another partitioning, copies included."""
    from panelspark.operators import corpus as C
    from panelspark.operators import mlm as M
    rows = [("h", "d", ["[CLS]", "000001", "000002", "[SEP]"])] * 3 + [("h", "d", ["[CLS]", "000003", "[SEP]"]), ("g", "d", ["[CLS]", "000001", "[SEP]"])]
    sent = spark.createDataFrame(rows, "holder string, end_date string, tokens array<string>")
    vocab = C.vocabulary(sent)
    found = []
    for df in (sent, sent.repartition(5), sent.orderBy("tokens")):
        ids = sorted((r.holder, tuple(r.input_ids)) for r in M.token_ids(df, ["holder", "end_date"], vocab).collect())
        kept = sorted((r.holder, tuple(r.tokens)) for r in C.subsample(df, ["holder", "end_date"], sample=0.05).collect())
        found.append((ids, kept))
    assert found[0] == found[1] == found[2] and len(found[0][0]) == 5
    assert not any("monotonically" in line for line in M.token_ids(sent, ["holder", "end_date"], vocab)._jdf.queryExecution().toString().splitlines())


def test_keyed_permutation_and_batches(spark):
    from pyspark.sql import functions as F
    from panelspark.functions.rand import feistel
    from panelspark.operators import mlm as M
    from panelspark.plans.inspect import plan_text
    for n in (1, 2, 3, 5, 16, 17, 100, 101, 1000, 4097):
        got = [r.p for r in spark.range(n).select(feistel(F.col("id"), n, 7).alias("p")).collect()]
        assert sorted(got) == list(range(n)), n
        if n > 50:
            assert sum(i == p for i, p in enumerate(got)) < n / 4 and got != [r.p for r in spark.range(n).select(feistel(F.col("id"), n, 8).alias("p")).collect()]
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("text")).union(spark.createDataFrame([(5, "x"), (5, "x")], "id long, text string"))
    out = M.permuted_batches(rows, ["id"], batch_size=32, seed=3, buckets=16)
    got = out.collect()
    assert sorted(r.sample_idx for r in got) == list(range(1002)) and all(r.batch_id == r.sample_idx // 32 for r in got)
    again = M.permuted_batches(rows.repartition(9), ["id"], batch_size=32, seed=3, buckets=16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    text = plan_text(out, "simple")
    assert "rangepartitioning" not in text.lower()
    assert M.permuted_batches(rows.limit(0), ["id"]).count() == 0


def test_dense_cross_section_aggregates_the_panel_alone(spark):
    from panelspark.operators import panel as P
    days = [dt.date(2020, 1, d) for d in (1, 2, 3)]
    dates = spark.createDataFrame([(d,) for d in days], "value date")
    stocks = spark.createDataFrame([(f"{i:02d}",) for i in range(20)] + [("03",)], "value string")
    cells = [(days[0], "00", "stock", 1.0), (days[0], "19", "A", 2.0), (days[0], "19", "a", 3.0), (days[1], "07", "A", None), (days[1], "08", None, 9.0),
             (days[2], "off", "A", 4.0), (days[2], None, "a", 5.0), (dt.date(2021, 1, 1), "05", "A", 6.0), (dt.date(2021, 1, 1), "09", "A", 7.0)]
    panel = spark.createDataFrame(cells, "date date, stock string, factor string, value double")
    want = {(d, f"{i:02d}"): [None] * 3 for d in days for i in range(20)}
    for d, s, f, v in cells:
        row = want.setdefault((d, s), [None] * 3)
        if f:
            row[["A", "a", "stock"].index(f)] = v
    for options in ({}, {"stocks_per_task": 6}, {"stocks_per_task": 6, "max_broadcast_rows": 1}):
        wide = P.dense_cross_section(panel, ["A", "a", "stock"], dates, stocks, **options)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate") < plan.index("Aggregate")      # the grid is made above the aggregation, not below
        assert wide.columns == ["date", "stock", "A", "a", "stock"]
        rows = [tuple(r) for r in wide.collect()]
        assert len(rows) == len(want) and {r[:2]: list(r[2:]) for r in rows} == want
    empty = P.dense_cross_section(panel, ["A"], dates, stocks.limit(0))
    assert sorted(empty.select("date", "A").collect(), key=str) == sorted(
        [(d, v if f == "A" else None) for d, s, f, v in cells if (s, f) != ("19", "a")], key=str)
    with pytest.raises(Exception, match="duplicate panel key"):
        P.dense_cross_section(panel.union(panel.limit(1)), ["A", "a", "stock"], dates, stocks).collect()


def test_pool_axes_reads_its_pool_once(spark, tmp_path):
    from panelspark.operators import panel as P
    rows = [("f", "d1", "s1"), ("f", "d2", None), (None, "d1", "s1"), ("g", None, None), ("h", None, "s2")]
    spark.createDataFrame(rows, "file_key string, date string, stock string").write.parquet(str(tmp_path / "pool"))
    seen = []
    made, P.materialize = P.materialize, lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or made(df)
    try:
        axes = P.pool_axes(spark.read.parquet(str(tmp_path / "pool")), "file_key", {"date": "date", "stock": "stock"})
    finally:
        P.materialize = made
    assert seen[0].count("FileScan") == 1
    assert sorted(map(tuple, axes.collect()), key=str) == sorted([
        ("date", "d1", 2), ("date", "d2", 1), ("stock", "s1", 2), ("stock", "s2", 1), ("__file", "f", 1), ("__file", None, 1), ("__file", "h", 1)], key=str)
    assert P.axis_sizes(axes)["date"] == {"union": 2, "intersect": 0, "files": 3}
