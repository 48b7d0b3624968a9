"""Registered panel (PAN), layout (LAY) and alignment (ALN) queries.

The layout queries feed each layout's pool with V_PANEL shaped as that
layout's files would be after reading (file key + content); reading real
files of each layout is covered by round-trip tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import align as A
from panelspark.operators import layouts as L
from panelspark.operators import panel as P
from panelspark.operators.scratch import staged
from panelspark.plans import views as V

# ---------------------------------------------------------------- SQL views
V_PANEL_SQL = """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS stock, l_returnflag AS factor,
       sum(l_quantity) AS value FROM lineitem GROUP BY ALL"""
V_PANEL_M_SQL = """SELECT last_day(CAST(l_shipdate AS DATE)) AS date, CAST(l_suppkey AS VARCHAR) AS stock,
       l_returnflag AS factor, sum(l_quantity) AS value FROM lineitem GROUP BY ALL"""
V_PANEL_R_SQL = """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS stock, l_returnflag AS factor,
       sum(l_extendedprice) AS value FROM lineitem GROUP BY ALL"""


def _keyed_by(key_axis: str, intersect_axes: list[str], src: str = V_PANEL_SQL) -> str:
    """Oracle: rows on axes present for every file key."""
    conds = " AND ".join(
        f"{a} IN (SELECT {a} FROM p GROUP BY {a} HAVING count(DISTINCT {key_axis}) = (SELECT n FROM nk))"
        for a in intersect_axes)
    return f"""WITH p AS ({src}), nk AS (SELECT count(DISTINCT {key_axis}) AS n FROM p)
SELECT date, stock, factor, value FROM p WHERE {conds}"""


def _panel(spark, sf_dir, monthly=False):
    return V.v_panel(spark, sf_dir, monthly)


def _date_text(fmt):
    return F.date_format(F.col("date"), fmt)


# ---------------------------------------------------------------- pools
def pool1(spark, sf_dir):
    """Layout 1 cells: file = factor, rows = dates, columns = stocks."""
    p = _panel(spark, sf_dir)
    return p.select(F.col("factor").alias("file_key"), _date_text("yyyy-MM-dd").alias("row_label"),
                    F.col("stock").alias("col_label"), "value")


def pool2(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select(F.col("factor").alias("file_key"), "stock", _date_text("yyyy-MM-dd").alias("date"), "value")


def pool3(spark, sf_dir):
    p = _panel(spark, sf_dir, monthly=True)
    return p.select(F.col("stock").alias("file_key"), _date_text("yyyyMMdd").alias("row_label"),
                    F.col("factor").alias("col_label"), "value")


def pool4(spark, sf_dir):
    p = _panel(spark, sf_dir, monthly=True)
    return p.select(F.col("stock").alias("file_key"), _date_text("yyyy/M/d").alias("date"),
                    F.col("factor").alias("factor_name"), F.col("value").alias("factor_value"))


def pool5(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select(_date_text("yyyyMMdd").alias("file_key"), F.col("factor").alias("row_label"),
                    F.col("stock").alias("col_label"), "value")


def pool6(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select(_date_text("yyyyMMdd").alias("file_key"), "stock", "factor", "value")


def _out(c: L.Converted):
    return c.panel.select("date", "stock", "factor", "value")


def lay01(spark, sf_dir):
    return _out(L.layout1(pool1(spark, sf_dir)))


def lay02(spark, sf_dir):
    return _out(L.layout2(pool2(spark, sf_dir), stock_col=0, date_col=1, value_col=2))


def lay02_by_name(spark, sf_dir):
    return _out(L.layout2(pool2(spark, sf_dir), stock_col="stock", date_col="date", value_col="value"))


def lay03(spark, sf_dir):
    return _out(L.layout3(pool3(spark, sf_dir)))


def lay04(spark, sf_dir):
    return _out(L.layout4(pool4(spark, sf_dir)))


def lay05(spark, sf_dir):
    return _out(L.layout5(pool5(spark, sf_dir)))


def lay06(spark, sf_dir):
    return _out(L.layout6(pool6(spark, sf_dir)))


def _big(spark, sf_dir):
    l = V.table(spark, sf_dir, "lineitem")
    return l.select(F.col("l_suppkey").alias("stock"), F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("date"),
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def lay07(spark, sf_dir):
    _, wide = L.layout7(_big(spark, sf_dir), stock_col="stock", date_col="date",
                        factor_cols=["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return wide


LAY07_SQL = """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS stock,
       l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""


def lay07_long(spark, sf_dir):
    conv, _ = L.layout7(_big(spark, sf_dir), "stock", "date", ["l_quantity", "l_tax", "l_linestatus"])
    return conv.panel.groupBy("factor").agg(F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_numeric"),
                                            F.round(F.sum("value"), 2).alias("total"))


LAY07_LONG_SQL = """
SELECT 'l_quantity' AS factor, count(*) AS n_cells, count(l_quantity) AS n_numeric, round(sum(l_quantity), 2) AS total FROM lineitem
UNION ALL SELECT 'l_tax', count(*), count(l_tax), round(sum(l_tax), 2) FROM lineitem
UNION ALL SELECT 'l_linestatus', count(*), count(TRY_CAST(l_linestatus AS DOUBLE)), round(sum(TRY_CAST(l_linestatus AS DOUBLE)), 2) FROM lineitem"""


def lay08_convert_dispatch(spark, sf_dir):
    """LAY-8: the layout number picks the reader (here 4, by name)."""
    c = L.convert(4, pool4(spark, sf_dir), date_col="date", factor_name_col="factor_name",
                  factor_value_col="factor_value")
    return _out(c)


# ---------------------------------------------------------------- PAN
def pan01_roles_by_position(spark, sf_dir):
    pool = pool6(spark, sf_dir).select("file_key", "factor", "value", "stock")
    return _out(L.layout6(pool, stock_col=2, factor_name_col=0, factor_value_col=1))


def pan02_intersect_dates(spark, sf_dir):
    return P.axis_intersection(pool1(spark, sf_dir), "file_key", "row_label")


PAN02_SQL = f"""WITH p AS ({V_PANEL_SQL})
SELECT strftime(date, '%Y-%m-%d') AS value FROM p GROUP BY date
HAVING count(DISTINCT factor) = (SELECT count(DISTINCT factor) FROM p)"""


def pan03_union_stocks(spark, sf_dir):
    return P.axis_union(P.transpose_cells(pool5(spark, sf_dir)), "row_label")


PAN03_SQL = f"WITH p AS ({V_PANEL_SQL}) SELECT DISTINCT stock AS value FROM p"


def pan04_drop_counts(spark, sf_dir):
    c3 = pool3(spark, sf_dir)
    d = P.axis_drop_counts(c3, "file_key", "row_label").withColumn("axis", F.lit("dates"))
    f = P.axis_drop_counts(c3, "file_key", "col_label").withColumn("axis", F.lit("factors"))
    return d.unionByName(f)


PAN04_SQL = f"""WITH p AS ({V_PANEL_M_SQL}), nk AS (SELECT count(DISTINCT stock) AS n FROM p),
d AS (SELECT date, count(DISTINCT stock) AS c FROM p GROUP BY date),
f AS (SELECT factor, count(DISTINCT stock) AS c FROM p GROUP BY factor)
SELECT count(*) AS n_union, count(*) FILTER (WHERE c = (SELECT n FROM nk)) AS n_intersection,
       count(*) - count(*) FILTER (WHERE c = (SELECT n FROM nk)) AS n_dropped, 'dates' AS axis FROM d
UNION ALL
SELECT count(*), count(*) FILTER (WHERE c = (SELECT n FROM nk)), count(*) - count(*) FILTER (WHERE c = (SELECT n FROM nk)),
       'factors' FROM f"""


def pan05_big_table_axes(spark, sf_dir):
    conv, _ = L.layout7(_big(spark, sf_dir), "stock", "date", ["l_quantity"])
    return (conv.dates.select(F.lit("dates").alias("dim"), "value")
            .unionByName(conv.stocks.select(F.lit("stocks").alias("dim"), "value")))


PAN05_SQL = """SELECT DISTINCT 'dates' AS dim, strftime(l_shipdate, '%Y-%m-%d') AS value FROM lineitem
UNION ALL SELECT DISTINCT 'stocks', CAST(l_suppkey AS VARCHAR) FROM lineitem"""


def pan06_file_axis(spark, sf_dir):
    return P.file_axis(pool2(spark, sf_dir))


PAN06_SQL = "SELECT DISTINCT l_returnflag AS value FROM lineitem"


def _converted2(spark, sf_dir):
    """Layout 2 of a pool made once: its axes and its panel both read it."""
    return L.layout2(staged(pool2(spark, sf_dir), "panel-pool"))


def _wide2(spark, sf_dir):
    conv = _converted2(spark, sf_dir)
    factors = P.pivot_values(conv.factors)
    return conv, factors, P.cross_section(conv.panel, factors)


def pan07_cross_section(spark, sf_dir):
    _, factors, wide = _wide2(spark, sf_dir)
    return wide


def _pivot_sql(src):
    return f"""SELECT date, stock, max(value) FILTER (WHERE factor = 'A') AS "A",
       max(value) FILTER (WHERE factor = 'N') AS "N", max(value) FILTER (WHERE factor = 'R') AS "R"
FROM ({src}) GROUP BY date, stock"""


PAN07_SQL = _pivot_sql(_keyed_by("factor", ["date", "stock"]))


def pan08_reindex_dense(spark, sf_dir):
    conv = _converted2(spark, sf_dir)
    factors = P.pivot_values(conv.factors)
    dates = conv.dates.select(F.to_date("value").alias("value"))
    return P.dense_cross_section(conv.panel, factors, dates, conv.stocks)


PAN08_SQL = f"""WITH k AS ({_keyed_by("factor", ["date", "stock"])}),
w AS ({_pivot_sql(_keyed_by("factor", ["date", "stock"]))}),
d AS (SELECT DISTINCT date FROM k), s AS (SELECT DISTINCT stock FROM k)
SELECT d.date, s.stock, w."A", w."N", w."R" FROM d CROSS JOIN s LEFT JOIN w ON w.date = d.date AND w.stock = s.stock"""


def pan09_transpose(spark, sf_dir):
    t = P.transpose_cells(pool5(spark, sf_dir))
    return t.select(F.to_date("file_key", "yyyyMMdd").alias("date"), F.col("row_label").alias("stock"),
                    F.col("col_label").alias("factor"), "value")


PAN09_SQL = f"SELECT date, stock, factor, value FROM ({V_PANEL_SQL})"


def pan10_select_factors(spark, sf_dir):
    p = _panel(spark, sf_dir)
    chosen = spark.createDataFrame([("A",), ("R",)], "value string")
    return P.select_factors(p, chosen)


PAN10_SQL = f"SELECT * FROM ({V_PANEL_SQL}) WHERE factor IN ('A', 'R')"


def pan11_rows_per_date(spark, sf_dir):
    _, wide = L.layout7(_big(spark, sf_dir), "stock", "date", ["l_quantity"])
    return P.rows_per_date(wide)


PAN11_SQL = "SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n_rows FROM lineitem GROUP BY 1"


# ---------------------------------------------------------------- ALN
def _left(spark, sf_dir):
    return _panel(spark, sf_dir)


def _right(spark, sf_dir):
    l = V.table(spark, sf_dir, "lineitem")
    return (l.groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").cast("string").alias("stock"),
                      F.col("l_returnflag").alias("factor"))
            .agg(F.sum("l_extendedprice").alias("value")))


_COMMON_SQL = f"""(SELECT 'dates' AS dim, strftime(date, '%Y-%m-%d') AS value FROM ({V_PANEL_SQL})
  UNION SELECT 'stocks', stock FROM ({V_PANEL_SQL}) UNION SELECT 'factors', factor FROM ({V_PANEL_SQL}))
INTERSECT
(SELECT 'dates', strftime(date, '%Y-%m-%d') FROM ({V_PANEL_R_SQL})
  UNION SELECT 'stocks', stock FROM ({V_PANEL_R_SQL}) UNION SELECT 'factors', factor FROM ({V_PANEL_R_SQL}))"""


def aln01_common_stocks(spark, sf_dir):
    return A.common_labels(A.panel_axes(_left(spark, sf_dir)), A.panel_axes(_right(spark, sf_dir)), "stocks")


ALN01_SQL = f"SELECT * FROM ({_COMMON_SQL}) WHERE dim = 'stocks'"


def aln02_common_axes(spark, sf_dir):
    return A.common_labels(A.panel_axes(_left(spark, sf_dir)), A.panel_axes(_right(spark, sf_dir)))


ALN02_SQL = _COMMON_SQL


def aln03_restrict(spark, sf_dir):
    common, lr, rr = A.align(_left(spark, sf_dir), _right(spark, sf_dir))
    return lr.select(F.lit("left").alias("side"), "date", "stock", "factor", F.round("value", 2).alias("value")).unionByName(
        rr.select(F.lit("right").alias("side"), "date", "stock", "factor", F.round("value", 2).alias("value")))


_ALIGNED_SQL = f"""WITH c AS ({_COMMON_SQL}),
l AS (SELECT * FROM ({V_PANEL_SQL}) WHERE strftime(date, '%Y-%m-%d') IN (SELECT value FROM c WHERE dim = 'dates')
      AND stock IN (SELECT value FROM c WHERE dim = 'stocks') AND factor IN (SELECT value FROM c WHERE dim = 'factors')),
r AS (SELECT * FROM ({V_PANEL_R_SQL}) WHERE strftime(date, '%Y-%m-%d') IN (SELECT value FROM c WHERE dim = 'dates')
      AND stock IN (SELECT value FROM c WHERE dim = 'stocks') AND factor IN (SELECT value FROM c WHERE dim = 'factors')),
d AS (SELECT DISTINCT date FROM l INTERSECT SELECT DISTINCT date FROM r),
la AS (SELECT * FROM l WHERE date IN (SELECT date FROM d)),
ra AS (SELECT * FROM r WHERE date IN (SELECT date FROM d))"""

ALN03_SQL = _ALIGNED_SQL + """
SELECT 'left' AS side, date, stock, factor, round(value, 2) AS value FROM la
UNION ALL SELECT 'right', date, stock, factor, round(value, 2) FROM ra"""


def aln04_dates_with_data(spark, sf_dir):
    common, lr, rr = A.align(_left(spark, sf_dir), _right(spark, sf_dir))
    return A.dates_with_data(lr, rr)


ALN04_SQL = _ALIGNED_SQL + "\nSELECT date AS value FROM d"


def aln05_side_by_side(spark, sf_dir):
    common, lr, rr = A.align(_left(spark, sf_dir), _right(spark, sf_dir))
    factors = P.pivot_values(common.filter(F.col("dim") == "factors"))
    s = A.side_by_side(lr, rr, factors)
    return s.select("date", "stock", *[F.round(c, 2).alias(c) for c in s.columns if c not in ("date", "stock")])


ALN05_SQL = _ALIGNED_SQL + """,
lw AS (SELECT date, stock, max(value) FILTER (WHERE factor = 'A') AS A_l, max(value) FILTER (WHERE factor = 'N') AS N_l,
              max(value) FILTER (WHERE factor = 'R') AS R_l FROM la GROUP BY ALL),
rw AS (SELECT date, stock, max(value) FILTER (WHERE factor = 'A') AS A_r, max(value) FILTER (WHERE factor = 'N') AS N_r,
              max(value) FILTER (WHERE factor = 'R') AS R_r FROM ra GROUP BY ALL)
SELECT lw.date, lw.stock, round(A_l, 2) AS A_l, round(N_l, 2) AS N_l, round(R_l, 2) AS R_l,
       round(A_r, 2) AS A_r, round(N_r, 2) AS N_r, round(R_r, 2) AS R_r
FROM lw JOIN rw ON lw.date = rw.date AND lw.stock = rw.stock"""


def aln07_missing_stocks(spark, sf_dir):
    common, lr, rr = A.align(_left(spark, sf_dir), _right(spark, sf_dir))
    dates = A.dates_with_data(lr, rr).select(F.col("value").cast("string").alias("value"))
    stocks = common.filter(F.col("dim") == "stocks").select("value")
    return A.missing_stocks(lr, dates, stocks)


ALN07_SQL = _ALIGNED_SQL + """,
ns AS (SELECT count(*) AS n FROM c WHERE dim = 'stocks')
SELECT d.date, (SELECT n FROM ns) - coalesce(count(DISTINCT la.stock), 0) AS n_missing
FROM d LEFT JOIN la ON la.date = d.date GROUP BY d.date
HAVING (SELECT n FROM ns) - coalesce(count(DISTINCT la.stock), 0) > 0"""


QUERIES = {
    "lay01_factor_files_wide": lay01,
    "lay02_factor_files_long": lay02,
    "lay02_factor_files_by_name": lay02_by_name,
    "lay03_stock_files_wide": lay03,
    "lay04_stock_files_long": lay04,
    "lay05_date_files_wide": lay05,
    "lay06_date_files_long": lay06,
    "lay07_big_table_split": lay07,
    "lay07_big_table_long": lay07_long,
    "lay08_convert_dispatch": lay08_convert_dispatch,
    "pan01_roles_by_position": pan01_roles_by_position,
    "pan02_intersect_dates": pan02_intersect_dates,
    "pan03_union_stocks": pan03_union_stocks,
    "pan04_drop_counts": pan04_drop_counts,
    "pan05_big_table_axes": pan05_big_table_axes,
    "pan06_file_axis": pan06_file_axis,
    "pan07_cross_section": pan07_cross_section,
    "pan08_reindex_dense": pan08_reindex_dense,
    "pan09_transpose": pan09_transpose,
    "pan10_select_factors": pan10_select_factors,
    "pan11_rows_per_date": pan11_rows_per_date,
    "aln01_common_stocks": aln01_common_stocks,
    "aln02_common_axes": aln02_common_axes,
    "aln03_restrict": aln03_restrict,
    "aln04_dates_with_data": aln04_dates_with_data,
    "aln05_side_by_side": aln05_side_by_side,
    "aln07_missing_stocks": aln07_missing_stocks,
}

_LAY_FACTOR = _keyed_by("factor", ["date", "stock"])
_LAY_STOCK = _keyed_by("stock", ["date", "factor"], V_PANEL_M_SQL)
_LAY_DATE = _keyed_by("date", ["factor"])

ORACLE = {
    "lay01_factor_files_wide": _LAY_FACTOR,
    "lay02_factor_files_long": _LAY_FACTOR,
    "lay02_factor_files_by_name": _LAY_FACTOR,
    "lay03_stock_files_wide": _LAY_STOCK,
    "lay04_stock_files_long": _LAY_STOCK,
    "lay05_date_files_wide": _LAY_DATE,
    "lay06_date_files_long": _LAY_DATE,
    "lay07_big_table_split": LAY07_SQL,
    "lay07_big_table_long": LAY07_LONG_SQL,
    "lay08_convert_dispatch": _LAY_STOCK,
    "pan01_roles_by_position": _LAY_DATE,
    "pan02_intersect_dates": PAN02_SQL,
    "pan03_union_stocks": PAN03_SQL,
    "pan04_drop_counts": PAN04_SQL,
    "pan05_big_table_axes": PAN05_SQL,
    "pan06_file_axis": PAN06_SQL,
    "pan07_cross_section": PAN07_SQL,
    "pan08_reindex_dense": PAN08_SQL,
    "pan09_transpose": PAN09_SQL,
    "pan10_select_factors": PAN10_SQL,
    "pan11_rows_per_date": PAN11_SQL,
    "aln01_common_stocks": ALN01_SQL,
    "aln02_common_axes": ALN02_SQL,
    "aln03_restrict": ALN03_SQL,
    "aln04_dates_with_data": ALN04_SQL,
    "aln05_side_by_side": ALN05_SQL,
    "aln07_missing_stocks": ALN07_SQL,
}
