"""End-to-end chains with file I/O (E1 panel conversion, E2 holdings,
E3 corpus and training rows).  Each is a few lazy DataFrame plans and
one write per output."""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import corpus as C
from panelspark.operators import holdings as H
from panelspark.operators import layouts as L
from panelspark.operators import mlm as M
from panelspark.operators import panel as P
from panelspark.sources import folders
from panelspark.sources import readers as R
from panelspark.sources import writers as W
from panelspark.session import scratch_path

WIDE_LAYOUTS = {1, 3, 5}


# Roles of the three-column layouts, by position unless named.
ROLES = {2: {"stock_col": 0, "date_col": 1, "value_col": 2},
         4: {"date_col": 0, "factor_name_col": 1, "factor_value_col": 2},
         6: {"stock_col": 0, "factor_name_col": 1, "factor_value_col": 2}}


def read_layout(spark: SparkSession, layout: int, input_path: str, fmt: str = "csv", keep_text: bool = True, **roles) -> L.Converted:
    """LAY-1..7 from files: the layout's reader, then its axis rules.

    Roles are resolved in each file's own header.  The panel has every cell as
    it stands in ``value_text`` beside its number (``keep_text``); ``panel.typed``
    keeps one of the two by the factor's type."""
    if layout == 7:
        return L.layout7(_big_table(spark, input_path, fmt), keep_text=keep_text, **roles)[0]
    files = R.list_files(spark, input_path, fmt)
    if layout in WIDE_LAYOUTS:
        return L.convert(layout, R.read_wide_cells(spark, input_path, fmt), files=files, keep_text=keep_text, **roles)
    if layout not in ROLES:
        raise ValueError(f"layout must be 1-7, got {layout}")
    asked = ROLES[layout] | roles
    pool = folders.keyed_roles(spark, input_path, fmt, asked)
    return L.convert(layout, pool, files=files, keep_text=keep_text, **{r: r for r in asked})


def _big_table(spark: SparkSession, input_path: str, fmt: str) -> DataFrame:
    if folders.is_file(spark, input_path):
        return R.read_auto(spark, input_path)
    return R.read_csv(spark, input_path) if fmt == "csv" else spark.read.format(fmt).load(input_path)


def convert_files(spark: SparkSession, layout: int, input_path: str, output_path: str, input_format: str = "csv",
                  output_format: str = "parquet", **roles) -> L.Converted:
    """LAY-8 / E1: read -> axes -> cross-sections per date -> manifest."""
    if layout == 7:
        conv, wide = L.layout7(_big_table(spark, input_path, input_format), keep_text=True, **roles)
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        out = wide.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        out = out.repartitionByRange(n, "date", "stock").sortWithinPartitions("date", "stock")
        w = out.write.mode("overwrite").partitionBy("date")
        if output_format == "csv":
            w.option("header", True).csv(output_path)
        elif output_format == "feather":
            W.write_feather(out, output_path, "overwrite")
        else:
            w.format(output_format).save(output_path)
    else:
        conv = read_layout(spark, layout, input_path, input_format, keep_text=True, **roles)
        W.write_cross_sections(conv, output_path, output_format)
    W.write_manifest(conv, os.path.join(output_path, "_manifest"), config_json=os.path.join(output_path, "config.json"),
                     layout=layout, input_path=input_path, output_path=output_path, input_format=input_format,
                     output_format=output_format)
    return conv


def load_converted(spark: SparkSession, folder: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """ALN-6: a converted folder as (long panel, manifest axes); only dates
    listed in the manifest and present on disk are read.

    Stocks stay text as written.  A factor's type is that of the manifest: ``value`` is the
    number, ``value_text`` the cell of a text factor (null for numbers).  A folder
    packed as maps gives the cells it has; its absent cells have no row."""
    axes = R.read_manifest(spark, os.path.join(folder, "_manifest"))
    reader = spark.read.option("basePath", folder).option("pathGlobFilter", f"*.{fmt}")   # not config.json
    if fmt == "csv":
        wide = reader.option("header", True).csv(folder)          # no inference: codes keep their zeros
    elif fmt == "feather":
        wide = R.read_feather(spark, folder)
    else:
        wide = reader.format(fmt).load(folder)
    factor_cols = [c for c in wide.columns if c not in ("date", "stock")]
    if sorted(factor_cols) == ["numbers", "texts"]:
        long = _unpacked(wide)
    else:
        long = wide.unpivot(["date", "stock"], [F.col(f"`{c}`").cast("string").alias(c) for c in factor_cols], "factor", "value_text")
        long = long.withColumn("value", P.to_number(F.col("value_text")))
        long = P.typed(long, P.materialize(R.read_manifest(spark, os.path.join(folder, "_manifest"), ("text_factors",)).select("value")))
    long = long.select(F.col("date").cast("date").alias("date"), "stock", "factor", "value", "value_text")
    dates = axes.filter(F.col("dim") == "dates").select(F.col("value").cast("date").alias("date"))
    return long.join(dates, "date", "left_semi").withColumn("stock", F.col("stock").cast("string")), axes


def _unpacked(wide: DataFrame) -> DataFrame:
    """Cells of cross-sections that were packed as maps (or as their JSON text)."""
    kinds = {"numbers": "map<string,double>", "texts": "map<string,string>"}
    both = wide.select("date", "stock", *[F.from_json(c, k).alias(c) if dict(wide.dtypes)[c] == "string" else F.col(c).cast(k).alias(c)
                                          for c, k in kinds.items()])
    numbers = both.select("date", "stock", F.explode("numbers").alias("factor", "value")).withColumn("value_text", F.lit(None).cast("string"))
    texts = both.select("date", "stock", F.explode("texts").alias("factor", "value_text")).withColumn("value", F.lit(None).cast("double"))
    return numbers.unionByName(texts)


def run_holdings(spark: SparkSession, input_dir: str, static_dir: str, output_dir: str,
                 per_holder: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """HLD-9 / E2: filings -> dimension tables (SNK-8) -> baskets (SNK-6)."""
    # the files are parsed once; three plans read the staged table, with one row order
    path = scratch_path(spark, "filings")
    R.read_filings(spark, input_dir).write.parquet(path)
    filings = spark.read.parquet(path)
    holders, industries, baskets = H.holdings_pipeline(filings)
    W.write_dimensions(holders, industries, static_dir)
    out = baskets.withColumn("EndDate", F.date_format("EndDate", "yyyy-MM-dd"))
    W.write_baskets(out, output_dir, per_holder=per_holder)
    return holders, industries, baskets


def stack_holder_files(spark: SparkSession, folder: str) -> DataFrame:
    """HLD-12: per-holder basket files stacked, holder id (file name less
    its last extension) as the first column."""
    df = R.read_keyed_folder(spark, folder, "csv", rule="last_ext", schema="EndDate string, Holdings string")
    return df.select(F.col("file_key").alias("ShareHolderID"), "EndDate", "Holdings")


def stack_holder_folders(spark: SparkSession, folder: str, holder: str = "ShareHolderID") -> DataFrame:
    """HLD-12 on the per-holder export of SNK-6 (a folder ``<holder>=<id>`` each):
    the holder id, kept as text, as the first column."""
    df = spark.read.schema(f"EndDate string, Holdings string, {holder} string").option("header", True).csv(folder)
    return df.select(holder, "EndDate", "Holdings")


def merge_baskets(df: DataFrame, output_dir: str, max_file_size_mb: float = 100,
                  filter_func: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """SNK-7 with the HLD-13 hook (e.g. ``lambda d: H.filter_holdings(d, 3)``)."""
    return W.write_merged(df, output_dir, max_file_size_mb, filter_func)


def training_inputs(spark: SparkSession, merged_dir: str, keys=("ShareHolderID", "EndDate")) -> DataFrame:
    """E3 input: merged basket CSVs -> sentences (bad rows dropped)."""
    df = R.read_csv(spark, os.path.join(merged_dir, "*.csv"), schema="ShareHolderID string, EndDate string, Holdings string")
    return C.sentences(df, "Holdings", keep=list(keys))


def dataset_index(spark: SparkSession, merged_dir: str) -> tuple[DataFrame, DataFrame]:
    """MLM-9/10 on files: (rows per file with cumulative offsets, rows with
    their global index).  Files are in name order; a row's position in its
    file follows the file's reading order (split start, position)."""
    from panelspark.operators.indexing import global_index
    df = R.read_csv(spark, os.path.join(merged_dir, "*.csv"), schema="ShareHolderID string, EndDate string, Holdings string")
    df = df.select("*", F.col("_metadata.file_name").alias("file_name"),
                   F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_pos"))
    offsets = M.file_offsets(M.rows_per_file(df))
    rows = global_index(df, ["file_name", "_block", "_pos"], "idx").drop("_block", "_pos")
    return offsets, rows


def training_set(sent: DataFrame, keys=("ShareHolderID", "EndDate"), max_length: int = 50, batch_size: int = 32,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """E3: (vocabulary, training rows with batch ids)."""
    vocab = C.vocabulary(sent)
    rows = M.training_rows(sent, list(keys), vocab, max_length=max_length, seed=seed)
    return vocab, M.shuffle_batches(rows, list(keys), batch_size=batch_size, seed=seed)
