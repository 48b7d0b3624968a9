"""Readers (SRC-1..9).

Folders of files become one DataFrame with the file key as a column;
CSV and Parquet are read by Spark's own scans, so column pruning and filters
reach the files and large files are split; Feather is read by record batches.
Files with headers of their own (wide panel files, keyed folders) go through
``sources.folders``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelspark.sources import feather, folders

# File formats by extension and the filing columns.
FORMATS = {"csv": "csv", "parquet": "parquet", "feather": "feather"}
FILING_COLUMNS = ["ShareHolderID", "SystematicsID", "FundID", "CategoryCode", "ShareHolderName", "Symbol",
                  "IndustryCode", "IndustryName", "EndDate", "Holdshares"]
FILING_SCHEMA = StructType([StructField(c, StringType()) for c in FILING_COLUMNS])
ALIAS_SCHEMA = StructType([StructField("code", StringType()), StructField("name", StringType())])


def format_of(path: str) -> str:
    """SRC-4: everything after the first dot of the file name."""
    base = os.path.basename(path.rstrip("/"))
    i = base.find(".")
    fmt = base[i + 1:] if i >= 0 else ""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt!r} ({path})")
    return fmt


def stem(col: str = "_file", rule: str = "first_dot"):
    """SRC-5 file key: ``first_dot`` (converters: ``a.b.csv`` -> ``a``) or
    ``last_ext`` (merger: ``a.b.csv`` -> ``a.b``)."""
    return folders.stem(F.col(col), rule)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """SRC-1: CSV with a header; the row label is an ordinary column."""
    r = spark.read.option("header", True)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2."""
    return spark.read.parquet(path)


def read_feather(spark: SparkSession, path: str, schema: str | StructType | None = None,
                 key_rule: str | None = None) -> DataFrame:
    """SRC-3: Feather (Arrow IPC) files, a task per range of record batches.

    The schema is given, or the union by name of the footers of all files (a
    metadata read, not data); a column that a file lacks is null there.  With
    ``key_rule`` a ``file_key`` column is added (SRC-5).
    """
    if schema is None:
        from pyspark.sql.pandas.types import from_arrow_schema
        schema = from_arrow_schema(feather.merged_schema(feather.feather_files(path)))
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if key_rule:
        schema = StructType(list(schema.fields) + [StructField("file_key", StringType())])
    return feather.read_batches(spark, path, schema, "table", key_rule or "first_dot")


def read_auto(spark: SparkSession, path: str, **options) -> DataFrame:
    """SRC-4: pick the reader from the file name."""
    fmt = format_of(path)
    if fmt == "csv":
        return read_csv(spark, path, **options)
    if fmt == "parquet":
        return read_parquet(spark, path)
    return read_feather(spark, path)


def read_keyed_folder(spark: SparkSession, folder: str, fmt: str = "csv", rule: str = "first_dot",
                      schema: StructType | str | None = None, **options) -> DataFrame:
    """SRC-5: all ``*.<fmt>`` files of a folder as one table + ``file_key``.

    Columns are matched by name, file by file; one that a file lacks is null
    there.  With a ``schema``, CSV columns are taken by position instead.
    ``folders.keyed_roles`` resolves roles (by position or name) in each file's own header.
    """
    if fmt == "feather":
        return read_feather(spark, folder, schema, key_rule=rule)
    if schema is None and not options:
        return folders.keyed_table(spark, folder, fmt, rule)
    glob = os.path.join(folder, f"*.{fmt}")
    df = read_csv(spark, glob, schema, **options) if fmt == "csv" else spark.read.parquet(glob)
    return df.withColumn("_file", F.col("_metadata.file_name")).withColumn("file_key", stem("_file", rule)).drop("_file")


def list_files(spark: SparkSession, folder: str, fmt: str = "csv", rule: str = "first_dot") -> DataFrame:
    """The file keys of a folder, empty files included (PAN-6)."""
    glob = os.path.join(folder, f"*.{fmt}")
    files = spark.read.format("binaryFile").load(glob).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("_file"))
    return files.select(stem("_file", rule).alias("file_key"))


def read_wide_cells(spark: SparkSession, folder: str, fmt: str = "csv", rule: str = "first_dot") -> DataFrame:
    """Wide layout files (1, 3, 5) to cells ``(file_key, row_label,
    col_label, value STRING)``; each file keeps its own header and null cells.
    Files are split like any other: a wide file spans as many tasks as its size asks for."""
    return folders.wide_cells(spark, folder, fmt, rule)


AXES = ("dates", "stocks", "factors")


def read_manifest(spark: SparkSession, path: str, dims: tuple[str, ...] = AXES) -> DataFrame:
    """SRC-6: the panel manifest as ``axis(dim, value)``; a list that the manifest lacks gives no rows."""
    m = spark.read.option("multiLine", True).json(path)
    out = spark.createDataFrame([], "dim string, value string")
    for d in dims:
        if d in m.columns:
            out = out.unionByName(m.select(F.lit(d).alias("dim"), F.explode(F.col(d).cast("array<string>")).alias("value")))
    return out


def read_filings(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-7: raw filings (all columns text) + ``row_order`` for first-wins.

    Row order = (file name, split start, position in split), the reading
    order of the files; file splits replace the reference's chunks.
    """
    df = spark.read.option("header", True).schema(FILING_SCHEMA).csv(os.path.join(folder, "*.csv"))
    order = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"))
    return df.withColumn("row_order", order)


def read_w2v_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: word2vec text vectors -> (token, vector ARRAY<FLOAT>, index).

    The first line of the first file is the header ``n dim``; every other line
    is a vector, and one of another length raises.  ``index`` is the
    line's place among the vectors (from 0): the vocabulary index.
    """
    from panelspark.operators.indexing import global_index
    lines = spark.read.text(path).select(
        F.split(F.trim("value"), r"\s+").alias("f"), F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_pos")).filter("f[0] <> ''")
    rows = global_index(lines, ["_file", "_block", "_pos"], "_line")
    dim = rows.filter("_line = 0").select(F.col("f")[1].cast("int")).scalar()
    bad = F.raise_error(F.concat(F.lit("vector line of another length: "), F.col("f")[0])).cast("array<float>")
    values = F.transform(F.slice("f", 2, F.greatest(F.size("f") - 1, F.lit(0))), lambda x: x.cast("float"))
    return rows.filter("_line > 0").select(
        F.col("f")[0].alias("token"), F.when(F.size("f") == dim + 1, values).otherwise(bad).alias("vector"),
        (F.col("_line") - 1).alias("index"))


def read_alias(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: stock code/name table; codes stay text; row order kept."""
    df = spark.read.option("header", True).schema(ALIAS_SCHEMA).csv(path)
    order = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"))
    return df.withColumn("row_order", order)
