"""Aligning two converted panels (ALN-1..7).

Axes are label tables; the common axes are ``intersect``s, the restriction
is a semi join per axis (broadcast under a checked bound), and the side by
side table is an inner join on (date, stock).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import panel as P

AXIS_NAMES = ("dates", "stocks", "factors")


def axis_table(dates: DataFrame, stocks: DataFrame, factors: DataFrame) -> DataFrame:
    """(dim, value) rows for the three axes."""
    return (dates.select(F.lit("dates").alias("dim"), F.col("value").cast("string").alias("value"))
            .unionByName(stocks.select(F.lit("stocks").alias("dim"), F.col("value").cast("string").alias("value")))
            .unionByName(factors.select(F.lit("factors").alias("dim"), F.col("value").cast("string").alias("value"))))


def panel_axes(panel: DataFrame) -> DataFrame:
    """Axes of a long panel taken from its data (dates as ``yyyy-MM-dd``), in
    one pass: every row gives its three labels to one ``distinct``."""
    labels = [("dates", F.date_format("date", "yyyy-MM-dd")), ("stocks", F.col("stock").cast("string")),
              ("factors", F.col("factor").cast("string"))]
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), v.alias("value")) for d, v in labels])).alias("_a")
    return panel.select(each).select("_a.dim", "_a.value").distinct()


def common_labels(a: DataFrame, b: DataFrame, dim: str | None = None) -> DataFrame:
    """ALN-1 (one dim) / ALN-2 (all dims): labels in both axis tables."""
    if dim is not None:
        a, b = a.filter(F.col("dim") == dim), b.filter(F.col("dim") == dim)
    return a.select("dim", "value").intersect(b.select("dim", "value"))


def restrict_panel(panel: DataFrame, common: DataFrame) -> DataFrame:
    """ALN-3: keep the common dates, stocks and factors (three bounded
    broadcast semi joins, applied map-side in one stage)."""
    sizes = {r["dim"]: r["n"] for r in common.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    dates = common.filter(F.col("dim") == "dates").select(F.col("value").cast("date").alias("value"))
    stocks = common.filter(F.col("dim") == "stocks").select("value")
    factors = common.filter(F.col("dim") == "factors").select("value")
    out = P.restrict(panel, "date", dates, axis_rows=sizes.get("dates", 0))
    out = P.restrict(out, "stock", stocks, axis_rows=sizes.get("stocks", 0))
    return P.restrict(out, "factor", factors, axis_rows=sizes.get("factors", 0))


def dates_with_data(left: DataFrame, right: DataFrame) -> DataFrame:
    """ALN-4: common dates that have rows on both sides."""
    return (left.select("date").distinct().intersect(right.select("date").distinct())
            .select(F.col("date").alias("value")))


def side_by_side(left: DataFrame, right: DataFrame, factors: list[str],
                 suffixes: tuple[str, str] = ("_l", "_r")) -> DataFrame:
    """ALN-5: per (date, stock), the left factors then the right factors.

    Both sides are pivoted on the common factor list; equal column names get
    ``_l`` / ``_r`` (the reference leaves duplicate names).
    """
    lw = P.cross_section(left, factors)
    rw = P.cross_section(right, factors)
    lw = lw.select("date", "stock", *[F.col(f"`{f}`").alias(f"{f}{suffixes[0]}") for f in factors])
    rw = rw.select("date", "stock", *[F.col(f"`{f}`").alias(f"{f}{suffixes[1]}") for f in factors])
    return lw.join(rw, ["date", "stock"], "inner")


def align(left: DataFrame, right: DataFrame, left_axes: DataFrame | None = None,
          right_axes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ALN-2..5 end to end: (common axes, restricted left, restricted right).

    Common dates are further limited to dates with data on both sides.
    """
    la = left_axes if left_axes is not None else panel_axes(left)
    ra = right_axes if right_axes is not None else panel_axes(right)
    common = P.materialize(common_labels(la, ra))          # small: the common labels
    lr, rr = restrict_panel(left, common), restrict_panel(right, common)
    both = P.materialize(dates_with_data(lr, rr))
    n = both.count()
    return common, P.restrict(lr, "date", both, axis_rows=n), P.restrict(rr, "date", both, axis_rows=n)


def missing_stocks(panel: DataFrame, dates: DataFrame, stocks: DataFrame, strict: bool = False) -> DataFrame:
    """ALN-7: per kept date, how many kept stocks have no row.

    Counted per date against the stock-axis size (a scalar subquery), so no
    (date x stock) grid is built.  ``strict`` raises like ``.loc`` does.
    """
    n_stocks = stocks.select(F.count(F.lit(1))).scalar()
    present = (P.restrict(panel, "stock", stocks).groupBy("date")
               .agg(F.count_distinct("stock").alias("n_present")))
    d = dates.select(F.col("value").cast("date").alias("date")).distinct()
    out = (d.join(present, "date", "left")
           .select("date", (n_stocks - F.coalesce(F.col("n_present"), F.lit(0))).alias("n_missing"))
           .filter(F.col("n_missing") > 0))
    if strict:
        bad = out.limit(5).collect()
        if bad:
            raise KeyError(f"stocks missing on dates: {[(str(r.date), r.n_missing) for r in bad]}")
    return out
