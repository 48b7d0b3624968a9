"""Statistics over tables (STA-1..6).

The reference's online mean/variance accumulator becomes SQL aggregates:
count, sum and mean per group, and variance with a ``ddof`` that is NaN for
fewer than two values (even with ``ddof=0``, as the accumulator does).  All
are algebraic aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.indexing import running_aggregates



def _nan() -> Column:
    return F.lit(float("nan"))


def _var_from(n: Column, var_pop: Column, ddof: int) -> Column:
    """Variance with ``ddof`` from count and population variance."""
    return F.when(n < 2, _nan()).otherwise(var_pop * n / (n - F.lit(ddof)))


def summary(df: DataFrame, group: Sequence[str], value: str, ddof: int = 0) -> DataFrame:
    """STA-1 + STA-2 per group: count, sum, mean, var, std."""
    v = F.col(value).cast("double")
    agg = df.groupBy(*group).agg(F.count(v).alias("count"), F.sum(v).alias("sum"), F.avg(v).alias("mean"),
                                 F.var_pop(v).alias("_vp"))
    var = _var_from(F.col("count"), F.col("_vp"), ddof)
    return agg.select(*group, "count", "sum", "mean", var.alias("var"), F.sqrt(var).alias("std"))


def running_summary(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                    ddof: int = 0, num_partitions: int | None = None) -> DataFrame:
    """STA-3: the accumulator read after every value, per group in order.

    Skew-safe: a hot group is split across range partitions and continued
    with per-partition offsets (``indexing.running_aggregates``).  The
    variance comes from deviations, merged stretch by stretch, so it is exact
    also for values that are large against their spread.
    """
    r = running_aggregates(df, group, order, value, num_partitions)
    n = F.col("_rc")
    mean = F.when(n > 0, F.col("_rs") / n)
    var_pop = F.when(n > 0, F.col("_rm2") / n)
    var = _var_from(n, var_pop, ddof)
    return (r.withColumn("run_count", n).withColumn("run_sum", F.col("_rs"))
            .withColumn("run_sumsq", F.col("_rq")).withColumn("run_mean", mean)
            .withColumn("run_var", var).withColumn("run_std", F.sqrt(var))
            .drop("_rc", "_rs", "_rq", "_rm2"))


def epoch_report(log: DataFrame, report_every: int = 1, epoch: str = "epoch", loss: str = "loss",
                 ddof: int = 0) -> DataFrame:
    """STA-4: per epoch, mean and std of the loss; only epochs with
    ``epoch % report_every == 0`` are reported.  The accumulator restarts
    each epoch, so the statistics are per epoch."""
    kept = log.filter(F.pmod(F.col(epoch), F.lit(report_every)) == 0)
    s = summary(kept, [epoch], loss, ddof)
    return s.select(epoch, F.col("count").alias("n_steps"), F.col("mean").alias("loss_mean"),
                    F.col("std").alias("loss_std"))


def every_nth_step(log: DataFrame, n: int, step: str = "step") -> DataFrame:
    """STA-5: rows whose step is a multiple of ``n``."""
    return log.filter(F.pmod(F.col(step), F.lit(n)) == 0)


def non_finite_flags(df: DataFrame, cols: Sequence[str] | None = None,
                     group: Sequence[str] = ()) -> DataFrame:
    """STA-6: per numeric column, whether any value is NaN or infinite."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint", "decimal"}
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString().split("(")[0] in numeric]
    aggs = [F.coalesce(F.bool_or(F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))),
                       F.lit(False)).alias(f"{c}_non_finite") for c in cols]
    return df.groupBy(*group).agg(*aggs)
