"""Holdings: filings -> dimension tables -> share-ordered baskets (HLD-1..13).

Scale notes
-----------
* First-wins dimensions use ``min_by`` in a grouped aggregation: partial
  aggregation runs map-side, so a holder with a third of all rows is reduced
  in every map task before the shuffle (no window, no sort of a hot group).
* A basket is one row per (holder, date), as in the reference (one CSV
  cell), so its own group must fit in a task; hot *holders* or hot *dates*
  are fine because the key is the pair.  ``salt_buckets > 1`` cuts the
  collect-and-sort of a hot pair across tasks (an extra shuffle, measured
  +45 % at sf0.1, so it is opt-in).  For pairs that cannot fit one row,
  ``basket_items`` gives the same order in long form, ranked by a
  range-partitioned segmented scan that splits any group across tasks.
* The valid-holder filter is a semi join; Spark broadcasts the holder table
  only when its measured size is under ``autoBroadcastJoinThreshold`` and
  otherwise shuffles both sides (AQE may still convert it at run time).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.scalars import basket_text, basket_text_count

HOLDER_ATTRS = ["SystematicsID", "FundID", "CategoryCode", "ShareHolderName"]
INDUSTRY_ATTRS = ["IndustryCode", "IndustryName"]
DEFAULT_SALT_BUCKETS = 1


def first_wins(df: DataFrame, key: str, attrs: Sequence[str], order: Column | str) -> DataFrame:
    """One row per ``key``: the attributes of its first row in ``order``.

    Null keys are dropped, as pandas ``groupby`` drops them.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    picked = F.min_by(F.struct(*[F.col(a) for a in attrs]), order_col).alias("_w")
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(picked)
            .select(key, *[F.col(f"_w.{a}").alias(a) for a in attrs]))


def holder_dimension(filings: DataFrame, order: Column | str = "row_order") -> DataFrame:
    """HLD-1: ShareHolderID + four attributes of its first filing row."""
    return first_wins(filings, "ShareHolderID", HOLDER_ATTRS, order)


def industry_dimension(filings: DataFrame, order: Column | str = "row_order") -> DataFrame:
    """HLD-2 + HLD-3: Symbol -> industry of its first row; symbols whose
    winning row lacks code or name are dropped (no later row rescues them)."""
    first = first_wins(filings, "Symbol", INDUSTRY_ATTRS, order)
    return first.filter(F.col("IndustryCode").isNotNull() & F.col("IndustryName").isNotNull())


# what counts as a number in text
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_shares(filings: DataFrame, shares_col: str = "Holdshares") -> DataFrame:
    """HLD-4: text to number (bad text -> null), keep shares > 0.

    ``NaN > 0`` is true in Spark, so NaN is excluded explicitly.
    """
    kind = filings.schema[shares_col].dataType.simpleString()
    # text is converted leniently; a numeric column keeps its filter pushable
    text = F.trim(F.col(shares_col).cast("string"))
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))       # Spark's cast also takes "100d" and "1f"
    x = number if kind == "string" else F.col(shares_col).cast("double")
    return filings.withColumn(shares_col, x).filter((F.col(shares_col) > 0) & ~F.isnan(F.col(shares_col)))


def valid_holdings(filings: DataFrame, holders: DataFrame, key: str = "ShareHolderID") -> DataFrame:
    """HLD-5: keep rows whose holder is in the holder dimension."""
    return filings.join(holders.select(key), on=key, how="left_semi")


HEAVY_ROWS = 2_000_000     # of a (holder, date) that is ranked over several tasks
HEAVY_BYTES = 1 << 30      # of the plan's sources, below which no pair is looked for


def source_bytes(df: DataFrame) -> int:
    """Estimated bytes of the sources of a plan."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def heavy_pairs(base: DataFrame, holder: str, date: str) -> DataFrame | None:
    """Pairs of more than ``HEAVY_ROWS`` rows, counted over the two keys (map-side first); None if there are none."""
    from panelspark.operators.panel import materialize
    if source_bytes(base) < HEAVY_BYTES:
        return None
    found = materialize(base.groupBy(holder, date).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HEAVY_ROWS).select(holder, date))
    return None if found.isEmpty() else found


def heavy_baskets(rows: DataFrame, holder: str, date: str, symbol: str, shares: str) -> DataFrame:
    """Baskets of heavy pairs: a range sort over (pair, shares, symbol) cuts a pair into sorted runs, one per task,
    which are put together in their order; only that last step, the basket itself, is one row's work."""
    from panelspark.operators.indexing import sorted_tagged
    order = [(-F.col(shares)).asc_nulls_first(), F.col(symbol).asc_nulls_first()]
    tagged = sorted_tagged(rows.select(holder, date, symbol, shares), order, partition_first=[holder, date])
    runs = tagged.groupBy(holder, date, "_pid").agg(F.sort_array(F.collect_list(F.struct("_mid", symbol))).alias("_r"))
    runs = runs.select(holder, date, "_pid", F.transform("_r", lambda x: x[symbol]).alias("_r"))
    whole = runs.groupBy(holder, date).agg(F.sort_array(F.collect_list(F.struct("_pid", "_r"))).alias("_r"))
    return whole.select(holder, date, F.flatten(F.transform("_r", lambda x: x["_r"])).alias("symbols"))


def baskets(holdings: DataFrame, holder: str, date: str, symbol: str, shares: str,
            salt_buckets: int = DEFAULT_SALT_BUCKETS, collapse_copies: bool = False) -> DataFrame:
    """HLD-6: per (holder, date), symbols ordered by shares descending, ties
    by symbol; repeated symbols are kept; null holder or date dropped.

    ``collapse_copies``: identical (holder, date, symbol, shares) rows are
    counted map-side before any shuffle and expanded again after the sort,
    so a flood of copies moves and sorts as one item (one extra shuffle on
    data without copies, so it is opt-in).

    Pairs that hold very many rows are found by counting (large inputs only) and
    ranked over several tasks (``heavy_baskets``); all others are one task's sort.

    Returns (holder, date, symbols ARRAY<symbol type>).
    """
    base = holdings.filter(F.col(holder).isNotNull() & F.col(date).isNotNull())
    heavy = None if collapse_copies or (salt_buckets and salt_buckets > 1) else heavy_pairs(base, holder, date)
    if heavy is not None:
        hot = heavy_baskets(base.join(F.broadcast(heavy), [holder, date], "left_semi"), holder, date, symbol, shares)     # rows / HEAVY_ROWS pairs at most
        base = base.join(F.broadcast(heavy), [holder, date], "left_anti")
    if collapse_copies:
        counted = base.groupBy(holder, date, symbol, shares).agg(F.count(F.lit(1)).alias("_n"))
        rows = counted.select(holder, date, F.struct((-F.col(shares)).alias("k"), F.col(symbol).alias("s"),
                                                     F.col("_n").alias("n")).alias("_it"))
    else:
        rows = base.select(F.col(holder), F.col(date),
                           F.struct((-F.col(shares)).alias("k"), F.col(symbol).alias("s")).alias("_it"))
    if salt_buckets and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(F.col("_it")), F.lit(salt_buckets)).alias("_salt")
        runs = (rows.groupBy(holder, date, salt)
                .agg(F.sort_array(F.collect_list("_it")).alias("_run")))
        merged = (runs.groupBy(holder, date)
                  .agg(F.sort_array(F.flatten(F.collect_list("_run"))).alias("_items")))
    else:
        merged = rows.groupBy(holder, date).agg(F.sort_array(F.collect_list("_it")).alias("_items"))
    if collapse_copies:
        symbols = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["s"], x["n"].cast("int"))))
    else:
        symbols = F.transform("_items", lambda x: x["s"])
    out = merged.select(holder, date, symbols.alias("symbols"))
    return out if heavy is None else out.unionByName(hot)


def basket_items(holdings: DataFrame, holder: str, date: str, symbol: str, shares: str,
                 num_partitions: int | None = None) -> DataFrame:
    """HLD-6 in long form: (holder, date, rank, symbol, shares), rank 0 =
    largest position, ties by symbol.  Skew-safe: no group is gathered in
    one task (``indexing.running_aggregates``)."""
    from panelspark.operators.indexing import running_aggregates
    rows = holdings.filter(F.col(holder).isNotNull() & F.col(date).isNotNull()).select(
        holder, date, symbol, F.col(shares).cast("double").alias(shares))
    r = running_aggregates(rows.withColumn("_one", F.lit(1.0)), [holder, date],
                           [F.col(shares).desc(), F.col(symbol).asc()], "_one", num_partitions)
    return r.select(holder, date, (F.col("_rc") - 1).cast("long").alias("rank"), symbol, shares)


def basket_table(holdings: DataFrame, holder: str, date: str, symbol: str, shares: str,
                 min_count: int = 0, salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """HLD-6/7/11: (holder, date, n_symbols, holdings text), n >= min_count."""
    b = baskets(holdings, holder, date, symbol, shares, salt_buckets)
    out = b.select(holder, date, F.size("symbols").cast("long").alias("n_symbols"), basket_text("symbols").alias("holdings"))
    return out.filter(F.col("n_symbols") >= min_count) if min_count else out


def parse_end_date(df: DataFrame, col: str = "EndDate") -> DataFrame:
    """HLD-8: report dates are ``%Y-%m-%d`` only; anything else raises."""
    s = F.col(col)
    d = F.try_to_timestamp(s, F.lit("yyyy-M-d")).cast("date")
    checked = F.when(s.isNull(), F.lit(None).cast("date")).when(
        d.isNull() | ~s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
        F.raise_error(F.concat(F.lit("bad EndDate: "), s)).cast("date")).otherwise(d)
    return df.withColumn(col, checked)


def count_elements(df: DataFrame, col: str = "Holdings", out: str = "n_elements") -> DataFrame:
    """HLD-10: element count of basket text (null -> 0, ``[]`` -> 1)."""
    return df.withColumn(out, basket_text_count(col))


def filter_holdings(df: DataFrame, n: int = 3, col: str = "Holdings") -> DataFrame:
    """HLD-11: keep baskets with at least ``n`` elements (text rule)."""
    return df.filter(basket_text_count(col) >= n)


def apply_filter(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """HLD-13: user table -> table hook (None = keep all)."""
    return df if fn is None else df.transform(fn)


def holdings_pipeline(filings: DataFrame, order: Column | str = "row_order",
                      salt_buckets: int = DEFAULT_SALT_BUCKETS,
                      valid_holders: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """HLD-9: (holder dimension, industry dimension, baskets).

    Baskets: (ShareHolderID, EndDate DATE, Holdings text), only holders in
    the dimension, shares > 0, share order.  All three are lazy; each output
    rescans the filings pruned to its own columns (persist the input if it
    is expensive to read).

    HLD-5 with the dimension built from these same filings keeps exactly the
    rows with a holder id, so no semi join (and no extra pass) is needed;
    pass ``valid_holders`` to filter by another holder table.
    """
    holders = holder_dimension(filings, order)
    industries = industry_dimension(filings, order)
    h = clean_shares(filings.select("ShareHolderID", "EndDate", "Symbol", "Holdshares"))
    h = valid_holdings(h, valid_holders) if valid_holders is not None else h.filter(F.col("ShareHolderID").isNotNull())
    h = parse_end_date(h, "EndDate")
    b = baskets(h, "ShareHolderID", "EndDate", "Symbol", "Holdshares", salt_buckets)
    b = b.select("ShareHolderID", "EndDate", basket_text("symbols").alias("Holdings"))
    return holders, industries, b
