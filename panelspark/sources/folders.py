"""Folders whose files carry headers of their own (SRC-5, LAY-1..6).

Files are scanned by Spark's own readers, split like any other, and a small
catalogue says what each file's columns are:

* CSV: the first line of each file (the least row of the split at byte 0) gives
  its header.  All files are scanned once by position, and each row meets its
  file's header in a join: names are resolved per file, wide rows become cells.
* Parquet: footers, read in tasks, group the files by schema; a group is one
  scan, in which roles are resolved and wide columns unpivoted.  (Spark refuses
  nanosecond timestamps unless spark.sql.legacy.parquet.nanosAsLong is set.)
* Feather: each record batch is projected by its own file's schema
  (``sources.feather``).

Headers are joined by broadcast only under a stated size (files and bytes).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.panel import materialize
from panelspark.sources import feather

MAX_FILES = 1_000_000      # broadcast: a path and a number each
MAX_HEADER_BYTES = 64 << 20
CELLS = ["file_key", "row_label", "col_label", "value"]


def stem(name: Column, rule: str) -> Column:
    if rule == "first_dot":
        return F.regexp_extract(name, r"^([^.]*)", 1)
    if rule == "last_ext":
        return F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    raise ValueError(rule)


def pattern(folder: str, fmt: str) -> str:
    return f"{folder.rstrip('/')}/*.{fmt}"


# ---------------------------------------------------------------- CSV
def csv_fields(line: Column) -> Column:
    """Fields of one CSV line, quoted ones without their quotes."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]++|"")*+"|[^,]*+)'), F.lit(1))
    bare = F.transform(quoted, lambda x: F.when(x.startswith('"') & (F.length(x) > 1), F.replace(
        F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, ",", -1))


def csv_headers(spark: SparkSession, glob: str) -> DataFrame:
    """(path, header ARRAY<STRING>), a row per file with a line; materialized."""
    lines = spark.read.text(glob).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
                                         F.monotonically_increasing_id().alias("_at")).filter("_start = 0 and trim(value) <> ''")
    first = lines.groupBy("path").agg(F.min_by("value", "_at").alias("line"))
    fields = csv_fields(F.regexp_replace("line", "^\ufeff", ""))
    return materialize(first.select("path", F.transform(fields, lambda x, i: F.when(
        x == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(x)).alias("header")))


def csv_rows(spark: SparkSession, glob: str, heads: DataFrame, rule: str) -> DataFrame:
    """(file_key, header, fields ARRAY<STRING>): all data lines of all files, by
    position; a line with more fields than its file's header raises."""
    width = heads.agg(F.max(F.size("header"))).first()[0] or 1
    names = [f"_c{i}" for i in range(width + 1)]                # one more than any header has
    rows = (spark.read.schema(", ".join(f"{c} string" for c in names)).option("header", True).option("enforceSchema", True)
            .option("quote", '"').option("escape", '"').option("maxColumns", max(20_480, width + 1)).csv(glob))
    rows = rows.select(F.array(*[F.nullif(F.col(c), F.lit("")) for c in names]).alias("fields"),
                       F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("_file"))
    number = F.xxhash64("header").alias("_kind")                # most files share their header
    kinds = materialize(heads.select(number, "header").distinct())
    size = kinds.agg(F.coalesce(F.sum(F.octet_length(F.concat_ws(",", "header"))), F.lit(0)).alias("b"), F.max(F.size("header")).alias("m")).first()
    files = heads.select("path", number)
    rows = rows.join(F.broadcast(files) if heads.count() <= MAX_FILES else files, "path")
    rows = rows.join(F.broadcast(kinds) if size["b"] <= MAX_HEADER_BYTES else kinds, "_kind")
    more = F.exists(F.slice("fields", F.size("header") + 1, width + 1), lambda x: x.isNotNull())
    checked = F.when(more, F.raise_error(F.concat(F.lit("line with more fields than its header: "), F.col("path"))).cast("array<string>")).otherwise(F.col("fields"))
    return rows.select(stem(F.col("_file"), rule).alias("file_key"), "header", checked.alias("fields"))


def _place(header: Column, role: int | str) -> Column:
    """Position of a role in a file's header, from 0; a name that is missing raises."""
    if isinstance(role, int):
        return F.lit(role)
    at = F.array_position(header, F.lit(role)).cast("int")
    return F.when(at == 0, F.raise_error(F.concat(F.lit(f"column {role!r} not in "), F.concat_ws(",", header))).cast("int")).otherwise(at - 1)


# ---------------------------------------------------------------- Parquet
def parquet_groups(spark: SparkSession, glob: str) -> list[tuple[list[str], list[str]]]:
    """Files with one schema each: (column names, paths).  Footers are read in tasks; a row per file comes back."""
    files = spark.read.format("binaryFile").load(glob).select("path")

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for b in batches:
            names, types = [], []
            for p in b.column(0).to_pylist():
                fs, base = feather.file_system(p)
                with fs.open_input_file(base) as fh:
                    s = pq.read_schema(fh)
                names.append(s.names)
                types.append([str(t) for t in s.types])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.list_(pa.string())), pa.array(types, pa.list_(pa.string()))],
                                             names=["path", "names", "types"])

    rows = files.mapInArrow(footers, "path string, names array<string>, types array<string>").collect()
    groups: dict[tuple, list[str]] = {}
    for r in sorted(rows, key=lambda r: r["path"]):
        groups.setdefault((tuple(r["names"]), tuple(r["types"])), []).append(r["path"])
    return [(list(names), paths) for (names, _), paths in groups.items()]


def _text(df: DataFrame, name: str) -> Column:
    """A column as text; a day as ``yyyy-MM-dd``, also where it is a timestamp at midnight."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.when(c.cast("timestamp_ntz") == F.date_trunc("day", c).cast("timestamp_ntz"), F.date_format(c, "yyyy-MM-dd")).otherwise(c.cast("string"))
    return c.cast("string")


def _union(parts: list[DataFrame], spark: SparkSession, empty: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], empty)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- readers
def wide_cells(spark: SparkSession, folder: str, fmt: str, rule: str = "first_dot") -> DataFrame:
    """Wide files (first column = row label) as (file_key, row_label, col_label, value STRING), nulls kept."""
    glob = pattern(folder, fmt)
    if fmt == "feather":
        return feather.read_batches(spark, folder, feather.CELL_SCHEMA, "cells", rule)
    if fmt == "csv":
        rows = csv_rows(spark, glob, csv_headers(spark, glob), rule)
        labels = F.slice("header", 2, F.size("header"))
        cells = F.arrays_zip(labels.alias("l"), F.slice("fields", F.lit(2), F.size("header") - 1).alias("v"))
        return (rows.select("file_key", F.get("fields", F.lit(0)).alias("row_label"), F.explode(cells).alias("c"))
                .select("file_key", "row_label", F.col("c.l").alias("col_label"), F.col("c.v").alias("value")))
    parts = []
    for names, paths in parquet_groups(spark, glob):
        df = spark.read.parquet(*paths)
        wide = df.select(stem(F.col("_metadata.file_name"), rule).alias("file_key"), _text(df, names[0]).alias("row_label"),
                         *[_text(df, c).alias(c) for c in names[1:]])
        cells = F.arrays_zip(F.array(*[F.lit(c) for c in names[1:]]).alias("l"), F.array(*[F.col(f"`{c}`") for c in names[1:]]).alias("v"))
        parts.append(wide.select("file_key", "row_label", F.explode(cells).alias("c"))
                     .select("file_key", "row_label", F.col("c.l").alias("col_label"), F.col("c.v").alias("value")))
    return _union(parts, spark, feather.CELL_SCHEMA)


def keyed_roles(spark: SparkSession, folder: str, fmt: str, roles: dict[str, int | str], rule: str = "first_dot") -> DataFrame:
    """``file_key`` and a text column per role, each resolved by position or name in its own file's header."""
    glob = pattern(folder, fmt)
    schema = "file_key string, " + ", ".join(f"{r} string" for r in roles)
    if fmt == "feather":
        return feather.read_batches(spark, folder, schema, "roles", rule, roles)
    if fmt == "csv":
        rows = csv_rows(spark, glob, csv_headers(spark, glob), rule)
        return rows.select("file_key", *[F.get("fields", _place(F.col("header"), c)).alias(r) for r, c in roles.items()])
    parts = []
    for names, paths in parquet_groups(spark, glob):
        lost = [c for c in roles.values() if (c not in names if isinstance(c, str) else c >= len(names))]
        if lost:
            raise KeyError(f"columns {lost} not in {names} ({paths[0]})")
        df = spark.read.parquet(*paths)
        parts.append(df.select(stem(F.col("_metadata.file_name"), rule).alias("file_key"),
                               *[_text(df, names[c] if isinstance(c, int) else c).alias(r) for r, c in roles.items()]))
    return _union(parts, spark, schema)


def keyed_table(spark: SparkSession, folder: str, fmt: str, rule: str = "first_dot") -> DataFrame:
    """All files as one table, columns by name, and ``file_key``; a column that a file lacks is null there."""
    glob = pattern(folder, fmt)
    key = stem(F.col("_metadata.file_name"), rule).alias("file_key")
    if fmt == "csv":
        heads = csv_headers(spark, glob)
        kinds = [r["header"] for r in heads.select("header").distinct().collect()]      # at most a row per file
        names = list(dict.fromkeys(c for k in sorted(kinds, key=len, reverse=True) for c in k))
        rows = csv_rows(spark, glob, heads, rule)
        return rows.select(*[F.get("fields", F.nullif(F.array_position("header", F.lit(c)).cast("int"), F.lit(0)) - 1).alias(c) for c in names], "file_key")
    groups = parquet_groups(spark, glob)
    if len(groups) == 1:
        df = spark.read.parquet(glob)
        return df.select("*", key)
    out = None
    for _, paths in groups:
        df = spark.read.parquet(*paths).select("*", key)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path that Spark reads is a single file."""
    if "://" not in path:
        return os.path.isfile(path)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(p).isFile()
