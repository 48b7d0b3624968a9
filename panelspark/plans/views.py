"""Fixture views over the driver's tables (FIXTURES.md part B).

Each view maps the TPC-H-like test tables to an input shape the reference
reads (filings, panels, token sentences, vectors, logs).  Every registered
query starts from one of these, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.scalars import basket_text, format_date, pad_id

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def v_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_HOLD: holder = o_custkey, end_date = month end of the order,
    symbol = part key (text), shares = quantity."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("holder"),
                    F.last_day(F.col("o_orderdate").cast("date")).alias("end_date"),
                    F.col("l_partkey").cast("string").alias("symbol"),
                    F.col("l_quantity").alias("shares")))


def v_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_FILING: raw filing rows with text shares and dirty values.

    Row order (first-wins) = (l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_quantity), exposed as the struct column ``row_order``.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = (l.join(o, l.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(p, F.col("l_partkey") == p.p_partkey))
    shares = (F.when(F.col("l_linenumber") == 5, F.lit("x"))
              .when(F.col("l_linenumber") == 6, (-F.col("l_quantity")).cast("string"))
              .otherwise(F.col("l_quantity").cast("string")))
    return j.select(
        F.col("o_custkey").cast("string").alias("ShareHolderID"),
        F.col("c_nationkey").cast("string").alias("SystematicsID"),
        F.col("o_orderkey").cast("string").alias("FundID"),
        F.col("c_mktsegment").alias("CategoryCode"),
        F.col("c_name").alias("ShareHolderName"),
        F.col("l_partkey").cast("string").alias("Symbol"),
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("IndustryCode"),
        F.col("p_type").alias("IndustryName"),
        format_date(F.last_day(F.col("o_orderdate").cast("date"))).alias("EndDate"),
        shares.alias("Holdshares"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("row_order"),
    )


def v_panel(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    """V_PANEL: long panel (date, stock, factor, value) from lineitem.

    date = ship day (or its month end with ``monthly``), stock = supplier,
    factor = return flag, value = summed quantity.
    """
    l = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_returnflag", "l_quantity")
    d = F.col("l_shipdate").cast("date")
    if monthly:
        d = F.last_day(d)
    # by the keys as they are: one string per row less to hash
    return (l.groupBy(d.alias("date"), "l_suppkey", F.col("l_returnflag").alias("factor"))
            .agg(F.sum("l_quantity").alias("value"))
            .select("date", F.col("l_suppkey").cast("string").alias("stock"), "factor", "value"))


def v_sent(spark: SparkSession, sf_dir: str, min_len: int = 3) -> DataFrame:
    """V_SENT: V_HOLD baskets (>= min_len ids, share order) as basket text.

    Columns: holder, end_date, holdings (text ``[a, b, c]``).
    """
    from panelspark.operators.holdings import baskets
    b = baskets(v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares")
    return (b.filter(F.size("symbols") >= min_len)
            .select("holder", "end_date", basket_text("symbols").alias("holdings")))


def v_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_ALIAS: code = part key padded to six, name = part name, row order = part key."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.select(pad_id(F.col("p_partkey").cast("string")).alias("code"), F.col("p_name").alias("name"),
                    F.col("p_partkey").alias("row_order"))


def v_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_VEC: token = vec_id (text), vector = embedding, index = vec_id order."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").cast("string").alias("token"), F.col("vec_id").alias("index"),
                    F.col("embedding").alias("vector"))


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_LOG: epoch = day of month of ts, step = event_id, loss = value."""
    e = table(spark, sf_dir, "events").select("ts", "event_id", "value")
    return e.select(F.dayofmonth("ts").cast("long").alias("epoch"), F.col("event_id").alias("step"),
                    F.col("value").alias("loss"))
