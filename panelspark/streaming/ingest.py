"""Structured Streaming entry points.

The reference reads its annual filing files in chunks and reports loss
statistics while training runs.  Both are incremental by nature:

* ``ingest_filings``: new filing CSVs in a folder are appended to a staged
  Parquet table, each micro-batch written to ``batch_id=<n>`` with
  overwrite, so a re-run batch replaces its own output (exactly once with
  the query checkpoint).  ``row_order`` (file, block, position) is added
  per batch, for first-wins dimensions later.
* ``epoch_report_stream``: per-epoch mean and std of a loss log that grows
  while training runs (STA-4 over a stream), in ``complete`` mode, since an
  epoch's statistics change as its steps arrive.

Checkpoints live under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelspark.operators.holdings import holdings_pipeline
from panelspark.sources.readers import FILING_SCHEMA
from panelspark.session import scratch_path


def filing_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int = 16) -> DataFrame:
    """New ``*.csv`` filings of a folder as a stream (all columns text)."""
    return (spark.readStream.schema(FILING_SCHEMA).option("header", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(input_dir)
            .withColumn("_file", F.col("_metadata.file_name"))
            .withColumn("_block", F.col("_metadata.file_block_start")))


def ingest_filings(spark: SparkSession, input_dir: str, table_path: str, checkpoint: str | None = None,
                   available_now: bool = True, max_files_per_trigger: int = 16) -> StreamingQuery:
    """Append new filing files to a staged Parquet table (one folder per batch)."""
    checkpoint = checkpoint or scratch_path(spark, "ingest-filings")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                         F.monotonically_increasing_id().alias("pos"))
        (batch.withColumn("row_order", order).drop("_file", "_block")
         .write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/batch_id={batch_id}"))

    w = (filing_stream(spark, input_dir, max_files_per_trigger).writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def staged_baskets(spark: SparkSession, table_path: str):
    """HLD-9 over the staged table: batches are read in order, so first-wins
    follows arrival order (batch, file, block, position)."""
    staged = spark.read.parquet(table_path)
    staged = staged.withColumn("row_order", F.struct(F.col("batch_id").alias("batch"), F.col("row_order").alias("o")))
    return holdings_pipeline(staged.drop("batch_id"), order="row_order")


def epoch_report_stream(log: DataFrame, report_every: int = 1, epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    """STA-4 on a streaming log: per reported epoch, count, mean and
    population std (NaN below two values)."""
    kept = log.filter(F.pmod(F.col(epoch), F.lit(report_every)) == 0)
    agg = kept.groupBy(epoch).agg(F.count(F.col(loss)).alias("n_steps"), F.avg(F.col(loss)).alias("loss_mean"),
                                  F.stddev_pop(F.col(loss)).alias("_sd"))
    return agg.select(epoch, "n_steps", "loss_mean",
                      F.when(F.col("n_steps") < 2, F.lit(float("nan"))).otherwise(F.col("_sd")).alias("loss_std"))


def run_epoch_report(spark: SparkSession, log_dir: str, schema: str, report_every: int = 1,
                     query_name: str = "epoch_report", checkpoint: str | None = None) -> StreamingQuery:
    """Stream a folder of Parquet log files into an in-memory table named
    ``query_name`` (``complete`` mode), processing what is there now."""
    log = spark.readStream.schema(schema).parquet(log_dir)
    checkpoint = checkpoint or scratch_path(spark, "epoch-report")
    return (epoch_report_stream(log, report_every).writeStream.outputMode("complete").format("memory")
            .queryName(query_name).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
