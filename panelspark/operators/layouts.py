"""Seven panel file layouts to one long panel (LAY-1..7).

Every layout reader in ``sources.readers`` yields a *pool*:

* wide layouts (1, 3, 5): one row per cell, ``(file_key, row_label,
  col_label, value)``, the value a number or text; null cells are kept, so labels decide membership;
* three-column layouts (2, 4, 6): the file's rows plus ``file_key``;
* layout 7: the big table itself.

``layoutN(pool, ...)`` applies the layout's axis rules and returns a
``Converted``: the restricted long panel plus the three axes (lazy
DataFrames) and whether cross-sections are reindexed to every kept stock.

Axis rules (intersect = label in every file):

====== ============ ============== ============== ===========
layout file key     dates          stocks         factors
====== ============ ============== ============== ===========
1      factor       intersect      intersect      file keys
2      factor       intersect      intersect      file keys
3      stock        intersect      file keys      intersect
4      stock        intersect      file keys      intersect
5      date         file keys      union          intersect
6      date         file keys      union          intersect
7      (one table)  distinct       distinct       named columns
====== ============ ============== ============== ===========
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.scalars import parse_date
from panelspark.operators import panel as P


@dataclass(frozen=True)
class Converted:
    panel: DataFrame          # (date, stock, factor, value)
    dates: DataFrame          # (value STRING) raw labels
    stocks: DataFrame
    factors: DataFrame
    dense: bool               # cross-sections list every kept stock
    layout: int


def _restrict_all(pool: DataFrame, axes: dict[str, DataFrame], sizes: dict[str, int] | None = None) -> DataFrame:
    """Semi join per axis; ``sizes`` (known label counts) skips re-counting."""
    for col, axis in axes.items():
        pool = P.restrict(pool, col, axis, axis_rows=(sizes or {}).get(col))
    return pool


def _axes(pool: DataFrame, labels: dict[str, str], files: DataFrame | None) -> DataFrame:
    return P.pool_axes(pool, "file_key", labels, files)


def _wide(cells: DataFrame, files: DataFrame | None, key_role: str, row_role: str, col_role: str,
          layout: int, keep_text: bool = False) -> Converted:
    """Layouts 1 and 3: file key is one axis, the other two intersect."""
    ax = _axes(cells, {"row_label": "row_label", "col_label": "col_label"}, files)
    roles = {key_role: "file_key", row_role: "row_label", col_role: "col_label"}
    axes = {"file_key": P.axis_from(ax, "", "files"),
            "row_label": P.axis_from(ax, "row_label"),
            "col_label": P.axis_from(ax, "col_label")}
    n = P.axis_sizes(ax)
    kept = _restrict_all(cells, {"row_label": axes["row_label"], "col_label": axes["col_label"]},
                         {c: n.get(c, {}).get("intersect", 0) for c in ("row_label", "col_label")})
    pan = P.to_panel(kept, F.col(roles["date"]), F.col(roles["stock"]), F.col(roles["factor"]), F.col("value"),
                     keep_text=keep_text)
    by_role = {r: axes[c] for r, c in roles.items()}
    return Converted(pan, by_role["date"], by_role["stock"], by_role["factor"], True, layout)


def layout1(cells: DataFrame, files: DataFrame | None = None, keep_text: bool = False) -> Converted:
    """LAY-1: file = factor, rows = dates, columns = stocks."""
    return _wide(cells, files, "factor", "date", "stock", 1, keep_text)


def layout3(cells: DataFrame, files: DataFrame | None = None, keep_text: bool = False) -> Converted:
    """LAY-3: file = stock, rows = dates, columns = factors."""
    return _wide(cells, files, "stock", "date", "factor", 3, keep_text)


def layout5(cells: DataFrame, files: DataFrame | None = None, keep_text: bool = False) -> Converted:
    """LAY-5: file = date, rows = factors, columns = stocks.

    Stocks are the union over files and each date keeps only its own
    stocks (no reindex); factors intersect.  The transpose (PAN-9) is a
    relabelling of cells.
    """
    t = P.transpose_cells(cells)   # rows = stocks, columns = factors
    ax = _axes(t, {"stock": "row_label", "factor": "col_label"}, files)
    factors = P.axis_from(ax, "factor")
    stocks = P.axis_from(ax, "stock", "union")
    kept = P.restrict(t, "col_label", factors, axis_rows=P.axis_sizes(ax).get("factor", {}).get("intersect", 0))
    pan = P.to_panel(kept, F.col("file_key"), F.col("row_label"), F.col("col_label"), F.col("value"), keep_text=keep_text)
    return Converted(pan, P.axis_from(ax, "", "files"), stocks, factors, False, 5)


def _three(pool: DataFrame, files: DataFrame | None, roles: dict[str, int | str], key_role: str,
           union_role: str | None, layout: int, dense: bool, keep_text: bool = False) -> Converted:
    cols = {r: P.resolve_role(pool.drop("file_key"), c) for r, c in roles.items()}
    std = pool.select("file_key", *[F.col(c).cast("string").alias(r) if r != "value" else F.col(c).alias(r)
                                    for r, c in cols.items()])
    label_roles = [r for r in ("date", "stock", "factor") if r != key_role]
    ax = _axes(std, {r: r for r in label_roles}, files)
    axes: dict[str, DataFrame] = {key_role: P.axis_from(ax, "", "files")}
    for r in label_roles:
        axes[r] = P.axis_from(ax, r, "union" if r == union_role else "intersect")
    n = P.axis_sizes(ax)
    kept = _restrict_all(std, {r: a for r, a in axes.items() if r != key_role and r != union_role},
                         {r: n.get(r, {}).get("intersect", 0) for r in label_roles})
    std_key = kept.withColumn(key_role, F.col("file_key"))
    pan = P.to_panel(std_key, F.col("date"), F.col("stock"), F.col("factor"), F.col("value"), keep_text=keep_text)
    return Converted(pan, axes["date"], axes["stock"], axes["factor"], dense, layout)


def layout2(pool: DataFrame, stock_col: int | str = 0, date_col: int | str = 1, value_col: int | str = 2,
            files: DataFrame | None = None, keep_text: bool = False) -> Converted:
    """LAY-2: file = factor; columns stock, date, value (by position or name)."""
    return _three(pool, files, {"stock": stock_col, "date": date_col, "value": value_col}, "factor", None, 2, True, keep_text)


def layout4(pool: DataFrame, date_col: int | str = 0, factor_name_col: int | str = 1,
            factor_value_col: int | str = 2, files: DataFrame | None = None,
            keep_text: bool = False) -> Converted:
    """LAY-4: file = stock; columns date, factor name, value."""
    return _three(pool, files, {"date": date_col, "factor": factor_name_col, "value": factor_value_col},
                  "stock", None, 4, True, keep_text)


def layout6(pool: DataFrame, stock_col: int | str = 0, factor_name_col: int | str = 1,
            factor_value_col: int | str = 2, files: DataFrame | None = None,
            keep_text: bool = False) -> Converted:
    """LAY-6: file = date; columns stock, factor name, value.  Stocks are
    the union over files; each date is reindexed to all of them."""
    return _three(pool, files, {"stock": stock_col, "factor": factor_name_col, "value": factor_value_col},
                  "date", "stock", 6, True, keep_text)


def layout7(table: DataFrame, stock_col: int | str = 0, date_col: int | str = 1,
            factor_cols: Sequence[int | str] = (2,), keep_text: bool = False) -> tuple[Converted, DataFrame]:
    """LAY-7: one big table.  Returns the long panel (numbers as DOUBLE;
    ``keep_text`` adds ``value_text``, every cell as it stands) and the selected
    wide rows ``(date, stock, factors...)`` for the split by date, which keeps every row.

    Only the named columns are read (column pruning reaches the scan).
    """
    stock = P.resolve_role(table, stock_col)
    date = P.resolve_role(table, date_col)
    factors = [P.resolve_role(table, c) for c in factor_cols]
    kind = table.schema[date].dataType.simpleString()
    day = (F.col(date).cast("date") if kind == "date" or kind.startswith("timestamp")      # no text to parse
           else parse_date(F.col(date).cast("string"), strict=True))
    wide = table.select(day.alias("date"),
                        F.col(stock).cast("string").alias("stock"), *[F.col(c) for c in factors])
    if keep_text:
        long = wide.unpivot(["date", "stock"], [F.col(c).cast("string").alias(c) for c in factors], "factor", "value_text")
        long = long.select("date", "stock", "factor", P.to_number(F.col("value_text")).alias("value"), "value_text")
    else:
        long = wide.unpivot(["date", "stock"], [F.col(c).cast("string").try_cast("double").alias(c) for c in factors],
                            "factor", "value")
    spark = table.sparkSession
    fac_axis = spark.createDataFrame([(c,) for c in factors], "value string")
    dates = wide.select(F.col("date").cast("string").alias("value")).distinct()
    stocks = wide.select(F.col("stock").alias("value")).distinct()
    return Converted(long, dates, stocks, fac_axis, False, 7), wide


def convert(layout: int, pool: DataFrame, files: DataFrame | None = None, **roles) -> Converted:
    """LAY-8 dispatch: layout number 1-7 to its reader."""
    fns = {1: layout1, 2: layout2, 3: layout3, 4: layout4, 5: layout5, 6: layout6}
    if layout == 7:
        return layout7(pool, **roles)[0]
    if layout not in fns:
        raise ValueError(f"layout must be 1-7, got {layout}")
    return fns[layout](pool, files=files, **roles)
