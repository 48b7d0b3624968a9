"""Long panel and its axes (PAN-1..11).

A panel is one long DataFrame ``(date DATE, stock STRING, factor STRING,
value DOUBLE)``; axes are small DataFrames of labels.  Axis membership is
decided by labels, not values: a null cell still counts as present.

Scale notes
-----------
* Intersections are ``distinct (file, label)`` then ``count`` per label,
  both with map-side partial aggregation; the file count is a scalar
  subquery, so nothing is collected.
* The pivot needs its value list (the factor axis).  It is the only list
  brought to the driver, and its size is checked against
  ``spark.sql.pivotMaxValues`` first.
* Broadcasts of an axis are guarded by a row-count bound; above it the
  semi join shuffles instead.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.scalars import parse_date

PANEL_COLS = ["date", "stock", "factor", "value"]
DEFAULT_BROADCAST_ROWS = 2_000_000


def resolve_role(df: DataFrame, role: int | str) -> str:
    """PAN-1: a column given by position or by name."""
    if isinstance(role, int):
        return df.columns[role]
    if role not in df.columns:
        raise KeyError(f"column {role!r} not in {df.columns}")
    return role


def file_count(files: DataFrame) -> Column:
    """Number of files as a scalar subquery (files with no rows count)."""
    return files.select(F.count(F.lit(1))).scalar()


def axis_intersection(pool: DataFrame, key: str, label: str, files: DataFrame | None = None) -> DataFrame:
    """PAN-2: labels present in every file.  Returns one column ``value``."""
    files = files if files is not None else pool.select(key).distinct()
    per = pool.select(F.col(key), F.col(label).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return (per.groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") == file_count(files)).select("value"))


def pool_axes(pool: DataFrame, key: str, labels: dict[str, str], files: DataFrame | None = None) -> DataFrame:
    """All axes of a pool in one pass, materialized: rows (dim, value, n_files)
    with ``n_files`` the number of files a label occurs in, plus the file
    keys under dim ``__file`` (from ``files`` when given: empty files count).

    One scan, one ``distinct`` of (file, dim, label) and one count per label,
    both with map-side partial aggregation; the result is the size of the
    label sets, not of the data.  Without ``files``, the key of a row with any
    label goes the same way, as a label of its own file.
    """
    names = [F.col(c).cast("string") for c in labels.values()]
    dims = [F.struct(F.lit(name).alias("dim"), c.alias("value"), c.isNotNull().alias("is")) for name, c in zip(labels, names)]
    k = F.col(key).cast("string")
    if files is None:
        dims.append(F.struct(F.lit("__file").alias("dim"), k.alias("value"), F.coalesce(*names).isNotNull().alias("is")))
    per = (pool.select(k.alias("_k"), F.explode(F.array(*dims)).alias("_a")).filter("_a.is")
           .select("_k", F.col("_a.dim").alias("dim"), F.col("_a.value").alias("value")).distinct())
    axes = per.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n_files"))
    if files is not None:
        keys = files.select(k.alias("value")).distinct()
        axes = axes.unionByName(keys.select(F.lit("__file").alias("dim"), "value", F.lit(1).cast("long").alias("n_files")))
    return materialize(axes)


def axis_from(axes: DataFrame, dim: str, how: str = "intersect") -> DataFrame:
    """One axis of ``pool_axes``: ``intersect`` (in every file), ``union``
    or ``files`` (the file keys)."""
    if how == "files":
        return axes.filter(F.col("dim") == "__file").select("value")
    a = axes.filter(F.col("dim") == dim)
    if how == "union":
        return a.select("value")
    total = axes.filter(F.col("dim") == "__file").select(F.count(F.lit(1))).scalar()
    return a.filter(F.col("n_files") == total).select("value")


def axis_sizes(axes: DataFrame) -> dict[str, dict[str, int]]:
    """Label counts of a materialized ``pool_axes`` table, per dim: all
    labels (``union``) and labels in every file (``intersect``).  One small
    aggregation over the label table."""
    total = axes.filter(F.col("dim") == "__file").count()
    rows = axes.groupBy("dim").agg(F.count(F.lit(1)).alias("u"),
                                   F.count_if(F.col("n_files") == total).alias("i")).collect()
    return {r["dim"]: {"union": r["u"], "intersect": r["i"], "files": total} for r in rows}


def axis_union(pool: DataFrame, label: str) -> DataFrame:
    """PAN-3 / PAN-5: labels present in any file."""
    return pool.select(F.col(label).alias("value")).filter(F.col("value").isNotNull()).distinct()


def axis_drop_counts(pool: DataFrame, key: str, label: str, files: DataFrame | None = None) -> DataFrame:
    """PAN-4: one row (n_union, n_intersection, n_dropped)."""
    files = files if files is not None else pool.select(key).distinct()
    per = pool.select(F.col(key), F.col(label).alias("value")).filter(F.col("value").isNotNull()).distinct()
    counts = per.groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
    total = file_count(files)
    return counts.agg(F.count(F.lit(1)).alias("n_union"),
                      F.count_if(F.col("_n") == total).alias("n_intersection")).select(
        "n_union", "n_intersection", (F.col("n_union") - F.col("n_intersection")).alias("n_dropped"))


def file_axis(files: DataFrame, key: str = "file_key") -> DataFrame:
    """PAN-6: the axis named by the file keys."""
    return files.select(F.col(key).alias("value")).distinct()


def materialize(small: DataFrame) -> DataFrame:
    """Compute a small derived table once (reliable checkpoint in the shared
    checkpoint folder), so size checks and later joins read it instead of
    recomputing it from the big input."""
    from panelspark.session import checkpoint_dir
    checkpoint_dir(small.sparkSession)
    return small.checkpoint(eager=True)


def restrict(df: DataFrame, col: str, axis: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
             axis_rows: int | None = None) -> DataFrame:
    """Keep rows whose ``col`` is on the axis (semi join).

    The axis is broadcast only under a proven bound: ``axis_rows`` when the
    caller knows it, else the axis is materialized once and counted.  Above
    the bound the semi join shuffles both sides.
    """
    a = axis.select(F.col("value").alias(col)).distinct()
    if axis_rows is None:
        a = materialize(a)
        axis_rows = a.count()
    return df.join(F.broadcast(a) if axis_rows <= max_broadcast_rows else a, on=col, how="left_semi")


def select_factors(panel: DataFrame, factors: DataFrame) -> DataFrame:
    """PAN-10: keep the chosen factors."""
    return restrict(panel, "factor", factors)


def assert_unique(panel: DataFrame, keys: Sequence[str] = ("date", "stock", "factor"), show: int = 20) -> None:
    """Trap 20: a repeated key has no defined cell value; raise listing keys."""
    dup = panel.groupBy(*keys).count().filter(F.col("count") > 1)
    rows = dup.limit(show).collect()
    if rows:
        raise ValueError(f"duplicate panel keys {list(keys)}: {[tuple(r)[:len(keys)] for r in rows]}")


def pivot_limit(axis: DataFrame) -> int:
    """Factors that a table has columns for; beyond it cross-sections are packed as maps."""
    return int(axis.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))


def pivot_values(axis: DataFrame, spark_conf_max: int | None = None) -> list[str]:
    """The factor list for a pivot, sorted, after a size check."""
    limit = spark_conf_max or pivot_limit(axis)
    vals = [r[0] for r in axis.select("value").distinct().orderBy("value").limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"factor axis has more than {limit} labels; raise spark.sql.pivotMaxValues")
    return vals


CONDITIONAL_PIVOT_MAX = 64


def cross_section(panel: DataFrame, factors: Sequence[str], on_duplicate: str = "raise", within: Sequence[str] = ()) -> DataFrame:
    """PAN-7: per (date, stock) one row, one column per factor.

    A (date, stock, factor) key is unique in a valid panel; a repeated key
    raises, naming it (``on_duplicate="max"`` keeps the largest value).  Up to
    ``CONDITIONAL_PIVOT_MAX`` factors it is one conditional aggregation (a
    single hash aggregate); beyond that, Spark's ``pivot``, which aggregates
    by factor first and places each value by index instead of testing every
    factor on every row.  The factor list is the size-checked axis from
    ``pivot_values``.  ``within`` names further key columns that a stock decides
    (its range and number), so that rows placed by them stay where they are; they
    stand between date and stock.
    """
    if on_duplicate not in ("raise", "max"):
        raise ValueError("on_duplicate is 'raise' or 'max'")

    def single(value: Column, n: Column, factor: Column) -> Column:
        if on_duplicate == "max":
            return value
        key = F.concat_ws(", ", F.col("date").cast("string"), F.col("stock"), factor)
        kind = dict(panel.dtypes)["value"]
        return F.when(n > 1, F.raise_error(F.concat(F.lit("duplicate panel key: "), key)).cast(kind)).otherwise(value)

    f = F.col("factor")
    if len(factors) > CONDITIONAL_PIVOT_MAX:
        cells = panel.groupBy("date", *within, "stock", "factor").agg(F.max("value").alias("_v"), F.count(F.lit(1)).alias("_n"))
        cells = cells.select("date", *within, "stock", "factor", F.when(f.isNull(), F.col("_v")).otherwise(
            single(F.col("_v"), F.col("_n"), f)).alias("value"))
        return cells.groupBy("date", *within, "stock").pivot("factor", list(factors)).agg(F.max("value"))
    names = [str(v) for v in factors]
    agg = panel.groupBy("date", *within, "stock").agg(
        *[F.max(F.when(f == F.lit(v), F.col("value"))).alias(f"_v{i}") for i, v in enumerate(factors)],
        *[F.count_if(f == F.lit(v)).alias(f"_n{i}") for i, v in enumerate(factors) if on_duplicate == "raise"])
    return agg.select("date", *within, "stock", *[
        single(F.col(f"_v{i}"), F.col(f"_n{i}") if on_duplicate == "raise" else F.lit(1), F.lit(v)).alias(v)
        for i, v in enumerate(names)])


def dense_grid(dates: DataFrame, stocks: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               by_date: int = 0) -> DataFrame:
    """Every kept (date, stock) pair.

    The output has |dates| x |stocks| rows by definition (the reference
    writes every kept stock for every date).  The stock axis is numbered
    0..n-1 (range-partitioned global index) and checked against the bound;
    each date row expands ``sequence(0, n-1)`` in its own task, and the
    numbers are resolved by an equi-join on the axis, broadcast under the
    bound and shuffled above it.  The dates keep their partitioning, so the
    grid is not shuffled while the axis is broadcast.
    """
    from panelspark.operators.indexing import global_index
    s = global_index(stocks.select(F.col("value").cast("string").alias("stock")).distinct(), ["stock"], "_si")
    n = s.count()
    d = dates.select(F.col("value").alias("date")).distinct()
    if by_date:
        d = d.repartition(by_date, "date")
    if n == 0:
        return d.select("date", F.lit(None).cast("string").alias("stock")).filter(F.lit(False))
    grid = d.select("date", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("_si"))
    return grid.join(F.broadcast(s) if n <= max_broadcast_rows else s, "_si").select("date", "stock")


STOCKS_PER_TASK = 200_000


def packed_cross_section(panel: DataFrame) -> DataFrame:
    """PAN-7 without a factor list: (date, stock, numbers MAP, texts MAP), a map entry per
    cell by its factor; for panels with more factors than a table has room for columns.
    A repeated key raises; cells that are absent have no entry."""
    has_text = "value_text" in panel.columns
    text = F.col("value_text") if has_text else F.lit(None).cast("string")
    cells = panel.filter("factor is not null").groupBy("date", "stock", "factor").agg(
        F.max("value").alias("_v"), F.max(text).alias("_t"), F.count(F.lit(1)).alias("_n"))
    key = F.concat_ws(", ", F.col("date").cast("string"), F.col("stock"), F.col("factor"))
    cells = cells.withColumn("factor", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate panel key: "), key)).cast("string"))
                             .otherwise(F.col("factor")))
    number = F.collect_list(F.when(F.col("_t").isNull() | F.col("_v").isNotNull(), F.struct("factor", F.col("_v").alias("v"))))
    words = F.collect_list(F.when(F.col("_t").isNotNull() & F.col("_v").isNull(), F.struct("factor", F.col("_t").alias("v"))))
    return cells.groupBy("date", "stock").agg(F.map_from_entries(F.array_sort(number)).alias("numbers"),
                                              F.map_from_entries(F.array_sort(words)).alias("texts"))


def dense_cross_section(panel: DataFrame, factors: Sequence[str], dates: DataFrame, stocks: DataFrame,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, stocks_per_task: int | None = None) -> DataFrame:
    """PAN-7 + PAN-8: every kept pair, each with its cells or nulls, from the panel's rows alone.

    The stock axis is numbered and cut into ranges.  The panel is shuffled once, by (date,
    range), with one seed row per (date, range) of the grid, and pivoted there; then each
    row, in the order of the numbers, also gives off the pairs up to the next row's.
    So only the panel is aggregated and sorted, in tasks that spill, and the grid is
    neither, nor shuffled while the numbers' labels can be broadcast.  Rows off
    the axes are given off as they are.

    Beyond ``stocks_per_task`` stocks a date has several ranges, so one date of any size spans many tasks."""
    from panelspark.operators.indexing import global_index
    n = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = global_index(stocks.select(F.col("value").cast("string").alias("stock")).distinct(), ["stock"], "_si")
    total = s.count()
    ranges = max(1, -(-total // (stocks_per_task or STOCKS_PER_TASK)))
    span = max(1, -(-total // ranges))
    s = F.broadcast(s) if total <= max_broadcast_rows else s

    numbered = s.select("_si", F.col("stock").alias("_label"))
    rows = panel.select("date", "stock", "factor", "value").join(numbered, F.col("stock").eqNullSafe(F.col("_label")), "left")
    rows = rows.select("date", F.coalesce(F.expr(f"_si div {span}"), F.lit(-1)).cast("long").alias("_range"),
                       F.coalesce("_si", F.lit(-1)).cast("long").alias("_si"), "stock", "factor", "value")
    d = dates.select(F.col("value").alias("date")).distinct().filter(F.lit(total > 0))
    d = d.withColumn("_range", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ranges - 1).cast("long"))))
    before = F.col("_range") * span - 1                       # the number of a seed
    seeds = d.repartition(n, "date", "_range").select(
        "date", "_range", before.alias("_si"), *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c in ("stock", "factor", "value")])
    both = cross_section(rows.repartition(n, "date", "_range").unionByName(seeds), factors, within=["_range", "_si"])
    cells = [f"_v{i}" for i in range(len(factors))]           # a factor may have any name
    both = both.toDF("date", "_range", "_si", "stock", *cells).withColumn("_seed", F.col("_si") == before)

    order = Window.partitionBy("date", "_range").orderBy("_si")
    end = F.least((F.col("_range") + 1) * span, F.lit(total).cast("long"))
    following = F.coalesce(F.lead("_si").over(order), end) - 1
    on_grid = F.max("_seed").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumn("_last", F.when(on_grid, following).otherwise(F.col("_si")))
    own = F.col("_at") == F.col("_si")
    pairs = both.withColumn("_at", F.explode(F.sequence("_si", "_last"))).filter(~(F.col("_seed") & own))
    pairs = pairs.join(s.select(F.col("_si").alias("_at"), F.col("stock").alias("_label")), "_at", "left")
    return pairs.select("date", F.coalesce("_label", F.when(own, F.col("stock"))).alias("stock"),
                        *[F.when(own, F.col(c)).alias(str(f)) for c, f in zip(cells, factors)])


def reindex_dense(wide: DataFrame, dates: DataFrame, stocks: DataFrame,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """PAN-8 for an existing wide table: left join onto the grid."""
    return dense_grid(dates, stocks, max_broadcast_rows).join(wide, ["date", "stock"], "left")


def transpose_cells(cells: DataFrame) -> DataFrame:
    """PAN-9: swap row and column labels of a cell table (file transpose)."""
    others = [c for c in cells.columns if c not in ("row_label", "col_label")]
    return cells.select(*others, F.col("col_label").alias("row_label"), F.col("row_label").alias("col_label"))


def rows_per_date(df: DataFrame, date: str = "date") -> DataFrame:
    """PAN-11 (query form of the split by date): rows per date."""
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("n_rows"))


def to_panel(df: DataFrame, date: Column, stock: Column, factor: Column, value: Column,
             strict_dates: bool = True, keep_text: bool = False) -> DataFrame:
    """Project to the long panel schema; date text parsed with SCA-1.

    ``keep_text`` adds ``value_text``, the cell as it stands, for factors
    that hold text (``text_factors``)."""
    number = to_number(value) if keep_text else value.try_cast("double")
    cols = [parse_date(date, strict=strict_dates).alias("date"), stock.cast("string").alias("stock"),
            factor.cast("string").alias("factor"), number.alias("value")]
    return df.select(*cols, *([value.cast("string").alias("value_text")] if keep_text else []))


# Numbers as the reference's reader takes them; Spark's own cast also takes "100d" and "1f".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Inf|INF|infinity|Infinity|nan|NaN)$"


def to_number(cell: Column) -> Column:
    """A cell as a number, null if its text is none."""
    text = F.trim(cell.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def typed(panel: DataFrame, as_text: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A panel with ``value_text`` whose cells follow their factor's type: all cells of a
    factor in ``as_text`` (column ``value``) are text, all others numbers."""
    t = as_text.select(F.col("value").alias("factor"), F.lit(True).alias("_text"))
    j = panel.join(F.broadcast(t) if t.count() <= max_broadcast_rows else t, "factor", "left")
    rest = [c for c in panel.columns if c not in ("value", "value_text")]
    return j.select(*rest, F.when(F.col("_text").isNull(), F.col("value")).alias("value"),
                    F.when(F.col("_text"), F.col("value_text")).alias("value_text"))


def text_factors(panel: DataFrame) -> DataFrame:
    """Factors with a cell that is no number (from ``value_text``): one column ``value``."""
    return (panel.groupBy("factor").agg(F.bool_or(F.col("value_text").isNotNull() & F.col("value").isNull()).alias("_t"))
            .filter("_t").select(F.col("factor").alias("value")))
