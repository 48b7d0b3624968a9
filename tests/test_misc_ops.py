"""Reader for aliases, rejects, raise modes and duplicate-key checks."""
import pytest
from pyspark.sql import functions as F

from panelspark.functions import rules as R
from panelspark.operators import align as A
from panelspark.operators import corpus as C
from panelspark.operators import panel as P
from panelspark.operators import quality as Q
from panelspark.sources import readers as RD


def test_alias_reader_keeps_codes_as_text(spark, tmp_path):
    f = tmp_path / "alias.csv"
    f.write_text("code,name\n000001,Alpha\n600614,Beta\n000003,Alpha\n")
    df = RD.read_alias(spark, str(f))
    assert [r.code for r in df.orderBy("row_order").collect()] == ["000001", "600614", "000003"]
    n2c, _ = C.alias_maps(df)
    assert {r.name: r.code for r in n2c.collect()}["Alpha"] == "000003"      # last row wins


def test_basket_rejects_reported(spark):
    df = spark.createDataFrame([("[000001, 600614]",), ("x",), (None,), ("[]",)], "Holdings string")
    assert C.rejects(df).count() == 2
    sent = C.sentences(df)
    assert sorted(len(r.tokens) for r in sent.collect()) == [2, 4]


def test_rules_raise_mode(spark):
    df = spark.createDataFrame([(1, "a"), (5, None), (9, "zz")], "n int, s string")
    rules = {"n": R.in_range(0, 8), "s": R.optional(R.length_between(1, 1)), "missing": R.always()}
    counts = Q.check_rules(df, rules).first().asDict()
    assert counts == {"n_violations": 1, "s_violations": 1}
    with pytest.raises(Q.RuleViolation):
        Q.check_rules(df, rules, mode="raise")
    ok = Q.check_rules(df, {"n": R.any_of(R.in_range(None, 2), R.in_range(4, None))}, mode="raise")
    assert ok.first()[0] == 0
    assert Q.check_rules(df, {"s": R.must_be_null()}, mode="flag").filter("s_ok").count() == 1
    assert Q.check_rules(df, {"n": R.equals(5)}).first()[0] == 2
    assert Q.check_rules(df, {"s": R.one_of(["a", None])}).first()[0] == 1


def test_duplicate_panel_keys_raise(spark):
    p = spark.createDataFrame([("2020-01-31", "S1", "ret", 1.0), ("2020-01-31", "S1", "ret", 2.0)],
                              "date string, stock string, factor string, value double")
    with pytest.raises(ValueError, match="duplicate panel keys"):
        P.assert_unique(p)


def test_missing_stocks_strict(spark):
    p = spark.createDataFrame([("2020-01-31", "S1", "ret", 1.0)], "date string, stock string, factor string, value double")
    p = p.withColumn("date", F.to_date("date"))
    dates = spark.createDataFrame([("2020-01-31",)], "value string")
    stocks = spark.createDataFrame([("S1",), ("S2",)], "value string")
    assert A.missing_stocks(p, dates, stocks).first().n_missing == 1
    with pytest.raises(KeyError):
        A.missing_stocks(p, dates, stocks, strict=True)


def test_cross_section_both_strategies_agree(spark):
    rows = [("2020-01-31", f"S{s}", f"f{k:03d}", float(s * 1000 + k)) for s in range(3) for k in range(70)]
    p = spark.createDataFrame(rows, "date string, stock string, factor string, value double")
    factors = [f"f{k:03d}" for k in range(70)]
    many = {r.stock: tuple(r[2:]) for r in P.cross_section(p, factors).collect()}               # pivot path
    few = {r.stock: tuple(r[2:]) for r in P.cross_section(p, factors[:10]).collect()}            # conditional path
    assert all(many[s][:10] == few[s] for s in few)
    assert many["S2"][69] == 2069.0


def test_training_rows_make_the_vocabulary_once(spark):
    from panelspark.operators import corpus as C
    from panelspark.operators import mlm as M
    sent = spark.createDataFrame([(1, ["[CLS]", "000001", "000002", "[SEP]"]), (2, ["[CLS]", "000002", "[SEP]"])], "rid int, tokens array<string>")
    rows = M.training_rows(sent, ["rid"], C.vocabulary(sent), max_length=6, mask_prob=0.0)
    assert "explode(tokens" not in rows._jdf.queryExecution().analyzed().toString()      # counted before, not again with the rows
    assert sorted((r.rid, sum(r.attention_mask)) for r in rows.collect()) == [(1, 4), (2, 3)]
