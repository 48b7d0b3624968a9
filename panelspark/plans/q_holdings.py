"""Registered holdings queries (HLD) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.scalars import basket_text, basket_text_count
from panelspark.operators import holdings as H
from panelspark.plans import views as V

# ---------------------------------------------------------------- SQL views
V_HOLD_SQL = """
SELECT o_custkey AS holder, last_day(CAST(o_orderdate AS DATE)) AS end_date,
       CAST(l_partkey AS VARCHAR) AS symbol, l_quantity AS shares
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

V_FILING_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS ShareHolderID, CAST(c_nationkey AS VARCHAR) AS SystematicsID,
       CAST(o_orderkey AS VARCHAR) AS FundID, c_mktsegment AS CategoryCode, c_name AS ShareHolderName,
       CAST(l_partkey AS VARCHAR) AS Symbol,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE p_brand END AS IndustryCode, p_type AS IndustryName,
       strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS EndDate,
       CASE WHEN l_linenumber = 5 THEN 'x' WHEN l_linenumber = 6 THEN CAST(-l_quantity AS VARCHAR)
            ELSE CAST(l_quantity AS VARCHAR) END AS Holdshares,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"""

# DuckDB prints a whole double like 17.0 as "17.0", Spark as "17.0" too.
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


# ---------------------------------------------------------------- flagship
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLD-4 -> HLD-5 -> HLD-6 -> HLD-7 -> HLD-11: baskets per holder and
    month end, share order, >= 3 stocks, holders with a positive balance."""
    h = H.clean_shares(V.v_hold(spark, sf_dir), "shares")
    valid = (V.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
             .select(F.col("c_custkey").alias("holder")))
    h = H.valid_holdings(h, valid, "holder")
    return H.basket_table(h, "holder", "end_date", "symbol", "shares", min_count=3)


FLAGSHIP_SQL = f"""
WITH h AS ({V_HOLD_SQL})
SELECT holder, end_date, count(*) AS n_symbols,
       '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS holdings
FROM h
WHERE shares > 0 AND NOT isnan(shares)
  AND holder IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
GROUP BY holder, end_date HAVING count(*) >= 3"""


# ---------------------------------------------------------------- HLD-1..3
def hld01_holder_dim(spark, sf_dir):
    return H.holder_dimension(V.v_filing(spark, sf_dir))


HLD01_SQL = f"""
WITH f AS ({V_FILING_SQL})
SELECT ShareHolderID,
       arg_min(SystematicsID, ({_ORDER})) AS SystematicsID,
       arg_min(FundID, ({_ORDER})) AS FundID,
       arg_min(CategoryCode, ({_ORDER})) AS CategoryCode,
       arg_min(ShareHolderName, ({_ORDER})) AS ShareHolderName
FROM f WHERE ShareHolderID IS NOT NULL GROUP BY ShareHolderID"""


def hld02_industry_dim(spark, sf_dir):
    return H.industry_dimension(V.v_filing(spark, sf_dir))


HLD02_SQL = f"""
WITH f AS ({V_FILING_SQL}),
w AS (SELECT *, row_number() OVER (PARTITION BY Symbol ORDER BY {_ORDER}) AS rn FROM f WHERE Symbol IS NOT NULL)
SELECT Symbol, IndustryCode, IndustryName FROM w
WHERE rn = 1 AND IndustryCode IS NOT NULL AND IndustryName IS NOT NULL"""


def hld03_dropped_symbols(spark, sf_dir):
    """Symbols whose winning (first) row lacks industry code or name."""
    f = V.v_filing(spark, sf_dir)
    first = H.first_wins(f, "Symbol", H.INDUSTRY_ATTRS, "row_order")
    kept = H.industry_dimension(f)
    return first.join(kept.select("Symbol"), "Symbol", "left_anti").select("Symbol")


HLD03_SQL = f"""
WITH f AS ({V_FILING_SQL}),
w AS (SELECT *, row_number() OVER (PARTITION BY Symbol ORDER BY {_ORDER}) AS rn FROM f WHERE Symbol IS NOT NULL)
SELECT Symbol FROM w WHERE rn = 1 AND (IndustryCode IS NULL OR IndustryName IS NULL)"""


# ---------------------------------------------------------------- HLD-4/5
def hld04_clean_shares(spark, sf_dir):
    f = V.v_filing(spark, sf_dir).select("ShareHolderID", "EndDate", "Symbol", "Holdshares")
    return (H.clean_shares(f).groupBy("EndDate")
            .agg(F.count("*").alias("n_rows"), F.sum("Holdshares").alias("total_shares")))


HLD04_SQL = f"""
WITH f AS ({V_FILING_SQL}),
c AS (SELECT EndDate, TRY_CAST(Holdshares AS DOUBLE) AS s FROM f)
SELECT EndDate, count(*) AS n_rows, sum(s) AS total_shares
FROM c WHERE s > 0 AND NOT isnan(s) GROUP BY EndDate"""


def hld05_valid_holders(spark, sf_dir):
    f = V.v_filing(spark, sf_dir)
    rich = (V.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000)
            .select(F.col("c_custkey").cast("string").alias("ShareHolderID")))
    h = H.valid_holdings(H.clean_shares(f.select("ShareHolderID", "Symbol", "Holdshares")), rich)
    return h.groupBy("ShareHolderID").agg(F.count("*").alias("n_rows"))


HLD05_SQL = f"""
WITH f AS ({V_FILING_SQL}),
c AS (SELECT ShareHolderID, TRY_CAST(Holdshares AS DOUBLE) AS s FROM f)
SELECT ShareHolderID, count(*) AS n_rows FROM c
WHERE s > 0 AND NOT isnan(s)
  AND ShareHolderID IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 5000)
GROUP BY ShareHolderID"""


# ---------------------------------------------------------------- HLD-6/7
def hld06_baskets(spark, sf_dir):
    b = H.baskets(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares")
    return b.select("holder", "end_date", F.size("symbols").cast("long").alias("n_symbols"),
                    basket_text("symbols").alias("holdings"))


HLD06_SQL = f"""
WITH h AS ({V_HOLD_SQL})
SELECT holder, end_date, count(*) AS n_symbols,
       '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS holdings
FROM h GROUP BY holder, end_date"""


def hld06_baskets_unsalted(spark, sf_dir):
    b = H.baskets(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares", salt_buckets=1)
    return b.select("holder", "end_date", F.size("symbols").cast("long").alias("n_symbols"),
                    basket_text("symbols").alias("holdings"))


def hld06_baskets_salted(spark, sf_dir):
    b = H.baskets(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares", salt_buckets=16)
    return b.select("holder", "end_date", F.size("symbols").cast("long").alias("n_symbols"),
                    basket_text("symbols").alias("holdings"))


def hld06_baskets_collapsed(spark, sf_dir):
    """Copies counted map-side before the shuffle, expanded after the sort."""
    b = H.baskets(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares", collapse_copies=True)
    return b.select("holder", "end_date", F.size("symbols").cast("long").alias("n_symbols"),
                    basket_text("symbols").alias("holdings"))


def hld06_basket_items(spark, sf_dir):
    """Skew-safe long form: (holder, end_date, rank, symbol, shares)."""
    return H.basket_items(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares")


HLD06_ITEMS_SQL = f"""
WITH h AS ({V_HOLD_SQL})
SELECT holder, end_date, row_number() OVER (PARTITION BY holder, end_date ORDER BY shares DESC, symbol) - 1 AS rank,
       symbol, shares
FROM h"""


# ---------------------------------------------------------------- HLD-9 (whole pipeline)
def hld09_pipeline_baskets(spark, sf_dir):
    _, _, b = H.holdings_pipeline(V.v_filing(spark, sf_dir))
    return b.select("ShareHolderID", "EndDate", "Holdings")


HLD09_SQL = f"""
WITH f AS ({V_FILING_SQL}),
c AS (SELECT ShareHolderID, CAST(EndDate AS DATE) AS EndDate, Symbol, TRY_CAST(Holdshares AS DOUBLE) AS s FROM f)
SELECT ShareHolderID, EndDate,
       '[' || string_agg(Symbol, ', ' ORDER BY s DESC, Symbol) || ']' AS Holdings
FROM c WHERE s > 0 AND NOT isnan(s) AND ShareHolderID IS NOT NULL AND EndDate IS NOT NULL
GROUP BY ShareHolderID, EndDate"""


def hld09_pipeline_industries(spark, sf_dir):
    _, ind, _ = H.holdings_pipeline(V.v_filing(spark, sf_dir))
    return ind


# ---------------------------------------------------------------- HLD-8 (date order per holder)
def hld08_date_order(spark, sf_dir):
    """Position of each basket in its holder's date order (parsed dates)."""
    from pyspark.sql import Window
    _, _, b = H.holdings_pipeline(V.v_filing(spark, sf_dir))
    w = Window.partitionBy("ShareHolderID").orderBy("EndDate")
    return b.select("ShareHolderID", "EndDate", F.row_number().over(w).cast("long").alias("seq"))


HLD08_SQL = f"""
WITH f AS ({V_FILING_SQL}),
c AS (SELECT DISTINCT ShareHolderID, CAST(EndDate AS DATE) AS EndDate FROM f
      WHERE TRY_CAST(Holdshares AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(Holdshares AS DOUBLE)))
SELECT ShareHolderID, EndDate, row_number() OVER (PARTITION BY ShareHolderID ORDER BY EndDate) AS seq FROM c"""


# ---------------------------------------------------------------- HLD-10/11/13
def _text_baskets(spark, sf_dir):
    b = H.baskets(V.v_hold(spark, sf_dir), "holder", "end_date", "symbol", "shares")
    return b.select(F.col("holder").cast("string").alias("ShareHolderID"), "end_date",
                    basket_text("symbols").alias("Holdings"))


def hld10_count_elements(spark, sf_dir):
    b = H.count_elements(_text_baskets(spark, sf_dir)).withColumn("n_elements", F.col("n_elements").cast("long"))
    return b.groupBy("n_elements").agg(F.count("*").alias("n_baskets"))


HLD10_SQL = f"""
WITH h AS ({V_HOLD_SQL}),
b AS (SELECT holder, end_date, '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS Holdings
      FROM h GROUP BY holder, end_date)
SELECT len(string_split(Holdings, ', ')) AS n_elements, count(*) AS n_baskets FROM b GROUP BY 1"""


def hld11_filter_holdings(spark, sf_dir):
    return H.filter_holdings(_text_baskets(spark, sf_dir), 3)


HLD11_SQL = f"""
WITH h AS ({V_HOLD_SQL}),
b AS (SELECT CAST(holder AS VARCHAR) AS ShareHolderID, end_date,
             '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS Holdings
      FROM h GROUP BY holder, end_date)
SELECT * FROM b WHERE len(string_split(Holdings, ', ')) >= 3"""


def hld13_user_filter(spark, sf_dir):
    """A user hook: keep baskets of at least 5 from the second half of 1998 on."""
    def recent_large(df):
        return df.filter((F.col("end_date") >= F.lit("1998-07-01").cast("date")) & (basket_text_count("Holdings") >= 5))
    return H.apply_filter(_text_baskets(spark, sf_dir), recent_large)


HLD13_SQL = f"""
WITH h AS ({V_HOLD_SQL}),
b AS (SELECT CAST(holder AS VARCHAR) AS ShareHolderID, end_date,
             '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS Holdings
      FROM h GROUP BY holder, end_date)
SELECT * FROM b WHERE end_date >= DATE '1998-07-01' AND len(string_split(Holdings, ', ')) >= 5"""


def hld12_stack(spark, sf_dir):
    """Baskets per nation and month end, written as one folder per holder (SNK-6), stacked again with the holder as a column."""
    from panelspark.plans import pipelines as PL
    from panelspark.session import scratch_path
    from panelspark.sources import writers as W
    c = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("holder"), F.format_string("%04d", F.col("c_nationkey")).alias("nation"))
    held = V.v_hold(spark, sf_dir).join(c, "holder")
    b = H.baskets(held, "nation", "end_date", "symbol", "shares")
    out = b.select(F.col("nation").alias("ShareHolderID"), F.date_format("end_date", "yyyy-MM-dd").alias("EndDate"), basket_text("symbols").alias("Holdings"))
    path = scratch_path(spark, "holders")
    W.write_baskets(out, path, per_holder=True)
    return PL.stack_holder_folders(spark, path)


HLD12_SQL = f"""
WITH h AS ({V_HOLD_SQL})
SELECT printf('%04d', c_nationkey) AS ShareHolderID, strftime(end_date, '%Y-%m-%d') AS EndDate,
       '[' || string_agg(symbol, ', ' ORDER BY shares DESC, symbol) || ']' AS Holdings
FROM h JOIN customer ON holder = c_custkey GROUP BY ALL"""


QUERIES = {
    "hld_flagship_baskets": flagship,
    "hld01_holder_dimension": hld01_holder_dim,
    "hld02_industry_dimension": hld02_industry_dim,
    "hld03_dropped_symbols": hld03_dropped_symbols,
    "hld04_clean_shares": hld04_clean_shares,
    "hld05_valid_holders": hld05_valid_holders,
    "hld06_baskets": hld06_baskets,
    "hld06_baskets_unsalted": hld06_baskets_unsalted,
    "hld06_baskets_salted": hld06_baskets_salted,
    "hld06_baskets_collapsed": hld06_baskets_collapsed,
    "hld06_basket_items": hld06_basket_items,
    "hld08_date_order": hld08_date_order,
    "hld09_pipeline_baskets": hld09_pipeline_baskets,
    "hld09_pipeline_industries": hld09_pipeline_industries,
    "hld10_count_elements": hld10_count_elements,
    "hld11_filter_holdings": hld11_filter_holdings,
    "hld12_stack": hld12_stack,
    "hld13_user_filter": hld13_user_filter,
}

ORACLE = {
    "hld_flagship_baskets": FLAGSHIP_SQL,
    "hld01_holder_dimension": HLD01_SQL,
    "hld02_industry_dimension": HLD02_SQL,
    "hld03_dropped_symbols": HLD03_SQL,
    "hld04_clean_shares": HLD04_SQL,
    "hld05_valid_holders": HLD05_SQL,
    "hld06_baskets": HLD06_SQL,
    "hld06_baskets_unsalted": HLD06_SQL,
    "hld06_baskets_salted": HLD06_SQL,
    "hld06_baskets_collapsed": HLD06_SQL,
    "hld06_basket_items": HLD06_ITEMS_SQL,
    "hld08_date_order": HLD08_SQL,
    "hld09_pipeline_baskets": HLD09_SQL,
    "hld09_pipeline_industries": HLD02_SQL,
    "hld10_count_elements": HLD10_SQL,
    "hld11_filter_holdings": HLD11_SQL,
    "hld12_stack": HLD12_SQL,
    "hld13_user_filter": HLD13_SQL,
}
