"""Hand-made cases (FIXTURES part C) for the scalar functions."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelspark.functions import scalars as S
from panelspark.operators import stats as ST


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_parse_date_patterns(spark):
    cases = {"2020-01-31": dt.date(2020, 1, 31), "2020/1/3": dt.date(2020, 1, 3), "20200131": dt.date(2020, 1, 31),
             "202001": dt.date(2020, 1, 1), "202012": dt.date(2020, 12, 1), "2020": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.d for r in df.select("s", S.parse_date("s").alias("d")).collect()}
    assert got == cases


def test_parse_date_strict_raises(spark):
    with pytest.raises(Exception, match="Unsupported date format"):
        one(spark, S.parse_date("s", strict=True), "2020")


def test_format_date(spark):
    assert one(spark, S.format_date(F.to_date("s")), "2020-1-3") == "2020-01-03"


def test_zero_padding(spark):
    for raw, want in [("1", "000001"), ("600614", "600614"), ("1234567", "1234567"), ("[CLS]", "0[CLS]"),
                      ("-5", "-00005")]:
        assert one(spark, S.pad_id("s"), raw) == want == raw.zfill(6)


def test_basket_text_parse(spark):
    assert one(spark, S.parse_basket("s"), "[000001, 600614]") == ["000001", "600614"]
    assert one(spark, S.parse_basket("s"), "[600614]") == ["600614"]
    assert one(spark, S.parse_basket("s"), "[]") == []
    assert one(spark, S.parse_basket("s"), "x") is None
    assert one(spark, S.parse_basket("s"), None) is None


def test_element_count(spark):
    assert one(spark, S.basket_text_count("s"), "[a, b, c]") == 3
    assert one(spark, S.basket_text_count("s"), "[]") == 1
    assert one(spark, S.basket_text_count("s"), None) == 0


def test_basket_text_roundtrip(spark):
    arr = ["000001", "600614", "300750"]
    df = spark.createDataFrame([(arr,)], "a array<string>")
    assert df.select(S.parse_basket(S.basket_text("a")).alias("r")).first().r == arr


def test_booleans(spark):
    want = {"yes": True, "N": False, "0": False, "maybe": None, "T": True, "1": True}
    df = spark.createDataFrame([(k,) for k in want], "s string")
    got = {r.s: r.b for r in df.select("s", S.str_to_bool("s").alias("b")).collect()}
    assert got == want


def test_key_value_map(spark):
    m = one(spark, S.kv_list_to_map("a"), ["a=1", "b=2=3", "a=4"], "a array<string>")
    assert m == {"a": "4", "b": "2=3"}


def test_sanitize_filename(spark):
    assert one(spark, S.sanitize_filename("s"), '  a/b:c*?"<>|d  ') == "a_b_c______d"


def test_variance_rules(spark):
    one_value = spark.createDataFrame([("g", 5.0)], "g string, x double")
    r = ST.summary(one_value, ["g"], "x").first()
    assert math.isnan(r["var"]) and r["count"] == 1
    two = spark.createDataFrame([("g", 1.0), ("g", 3.0)], "g string, x double")
    assert ST.summary(two, ["g"], "x", ddof=0).first()["var"] == pytest.approx(1.0)
    assert ST.summary(two, ["g"], "x", ddof=1).first()["var"] == pytest.approx(2.0)
