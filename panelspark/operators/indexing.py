"""Global row index and running aggregates without a partition-less window.

Both follow the same pattern (SURVEY 7.4-d):

1. range-partition the rows on the full sort key and sort each partition;
   the range partitioner samples the whole key, so a hot leading key (one
   count value, one epoch) is cut across many partitions;
2. tag every row with its partition id and its position in the partition,
   and checkpoint (reliable, in the shared ``spark.checkpoint.dir``) so the
   tags cannot change if a task is re-run;
3. aggregate per partition (a table of at most ``#partitions`` rows, or
   ``#partitions x #groups touching a boundary``), take cumulative offsets
   on that small table and broadcast it back.

No step puts more than one partition's rows into a task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import checkpoint_dir

_PID, _MID = "_pid", "_mid"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_tagged(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None = None,
                  partition_first: Sequence[Column | str] = ()) -> DataFrame:
    """Range-partitioned, sorted, tagged with (_pid, _mid), checkpointed."""
    keys = _cols(list(partition_first) + list(order))
    n = _num_partitions(df, num_partitions)
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn(_PID, F.spark_partition_id())
         .withColumn(_MID, F.monotonically_increasing_id()))
    checkpoint_dir(df.sparkSession)
    return s.checkpoint(eager=True)


def global_index(df: DataFrame, order: Sequence[Column | str], index_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (give a total order)."""
    s = sorted_tagged(df, order, num_partitions)
    counts = s.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition: a bounded broadcast
    offsets = counts.select(_PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (s.join(F.broadcast(offsets), _PID)
            .withColumn(index_col, (F.col("_off") + local).cast("long"))
            .drop(_PID, _MID, "_off"))


def distinct_rows(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, ``_h1``, ``_h2``, ``col``, ``_n``): each different row of ``keys`` and the
    array ``col`` once, with its number of copies.

    A row is named by its content, so the name is the same when a lost map
    output is computed again in another order; copies are counted map-side.
    Grouping by (keys, ``_h1``, ``_h2``) later needs no shuffle where the
    input is already partitioned by the keys."""
    counted = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    return counted.withColumn("_h1", F.xxhash64(col)).withColumn("_h2", F.xxhash64(F.lit(1), col))


def copies(df: DataFrame) -> DataFrame:
    """Each row ``_n`` times, without ``_n``."""
    return df.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).drop("_n")


def bucket_index(df: DataFrame, keys: Sequence[str], index_col: str = "idx", buckets: int = 1_024) -> DataFrame:
    """0-based position of every row in the order (bucket, keys, other columns); a
    row's bucket is the MD5 of its keys.

    Bucket sizes come from a count over the keys alone, and rows are placed and
    sorted by bucket, so whole rows are shuffled once, by their keys' hash, and
    neither sampled nor checkpointed; a partition's content and order are fixed
    by the rows, so a task that runs again gives the same numbers.  Give keys
    that tell rows apart well: rows of one key are in one bucket."""
    text = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    bucket = F.pmod(F.conv(F.substring(text, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
    counts = df.select(bucket.alias("_b")).groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per bucket: a bounded broadcast
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    others = [c for c, t in df.dtypes if c not in keys and not t.startswith("map")]
    placed = df.withColumn("_b", bucket).repartitionById(buckets, F.col("_b")).sortWithinPartitions(*keys, *others)
    local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return (placed.withColumn("_at", local).join(F.broadcast(offsets), "_b")
            .withColumn(index_col, (F.col("_off") + F.col("_at")).cast("long")).drop("_b", "_at", "_off"))


def running_aggregates(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                       value: str, num_partitions: int | None = None) -> DataFrame:
    """Per group, in ``order``: running count, sum, sum of squares and sum of
    squared deviations from the running mean of ``value``, up to and including
    each row (``_rc``, ``_rs``, ``_rq``, ``_rm2``).

    The deviations are taken within each (partition, group) stretch from the
    stretch's own mean, and stretches are merged by their counts, means and
    deviations, so values far from zero lose no precision.  Null values do
    not count, as in SQL aggregates.
    """
    s = sorted_tagged(df, order, num_partitions, partition_first=group)
    v = F.col(value).cast("double")
    part = (s.groupBy(_PID, *group)
            .agg(F.count(v).alias("_pn"), F.coalesce(F.sum(v), F.lit(0.0)).alias("_ps"),
                 F.coalesce(F.sum(v * v), F.lit(0.0)).alias("_pq"),
                 F.avg(v).alias("_pm"), (F.var_pop(v) * F.count(v)).alias("_pv")))
    earlier = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # deviations of all earlier stretches: within each, and of their means
    # from the first one's mean
    anchor = F.first("_pm", ignorenulls=True).over(Window.partitionBy(*group).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    part = part.withColumn("_d", F.col("_pm") - anchor)
    part = part.withColumn("_anchor", anchor)
    zero = F.lit(0.0)
    offs = part.select(_PID, *group, F.col("_anchor"),
                       F.coalesce(F.sum(F.col("_pn") * F.col("_d")).over(earlier), zero).alias("_od"),
                       F.coalesce(F.sum(F.col("_pv") + F.col("_pn") * F.col("_d") * F.col("_d")).over(earlier), zero).alias("_ov"),
                       F.coalesce(F.sum("_pn").over(earlier), F.lit(0)).alias("_on"),
                       F.coalesce(F.sum("_ps").over(earlier), F.lit(0.0)).alias("_os"),
                       F.coalesce(F.sum("_pq").over(earlier), F.lit(0.0)).alias("_oq"))
    # Only the first group of a partition can continue from earlier
    # partitions, so at most one offset row per partition survives.
    offs = offs.filter(F.col("_on") > 0)
    within = (Window.partitionBy(_PID, *group).orderBy(*_cols(order))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy(_PID, *group)
    mid = F.avg(v).over(whole)                                   # the stretch's own mean
    d = v - mid
    n0, d0 = F.coalesce(F.col("_on"), F.lit(0)), F.coalesce(F.col("_od"), F.lit(0.0))
    n1, s1 = F.count(v).over(within), F.coalesce(F.sum(d).over(within), F.lit(0.0))
    s2 = F.coalesce(F.sum(d * d).over(within), F.lit(0.0))
    m2_here = F.when(n1 > 0, s2 - s1 * s1 / n1).otherwise(0.0)
    m2_before = F.when(n0 > 0, F.col("_ov") - d0 * d0 / n0).otherwise(0.0)
    apart = F.when((n0 > 0) & (n1 > 0), (mid - F.col("_anchor") + s1 / n1) - d0 / n0).otherwise(0.0)
    merged = m2_before + m2_here + apart * apart * n0 * n1 / F.greatest(n0 + n1, F.lit(1))
    out = (s.join(F.broadcast(offs), [_PID, *group], "left")
           .withColumn("_rm2", F.greatest(merged, F.lit(0.0)))
           .withColumn("_rc", F.coalesce(F.col("_on"), F.lit(0)) + F.count(v).over(within))
           .withColumn("_rs", F.coalesce(F.col("_os"), F.lit(0.0)) + F.coalesce(F.sum(v).over(within), F.lit(0.0)))
           .withColumn("_rq", F.coalesce(F.col("_oq"), F.lit(0.0)) + F.coalesce(F.sum(v * v).over(within), F.lit(0.0))))
    return out.drop(_PID, _MID, "_on", "_os", "_oq", "_od", "_ov", "_anchor")
