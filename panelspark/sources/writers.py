"""Writers (SNK-1..10).

Outputs are written by the executors, partitioned, never collected.  Each
write is a Spark job with Spark's commit protocol (or, for Feather, a
Python data source whose tasks write temporary files that the driver
renames on commit), so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from dataclasses import dataclass
from typing import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from panelspark.functions.scalars import format_date
from panelspark.operators import panel as P
from panelspark.operators.indexing import sorted_tagged
from panelspark.operators.layouts import Converted


# Functions and classes of this module run inside tasks (mapInPandas,
# mapInArrow, the Feather data source).  Ship them by value so executors do
# not need the package installed (cluster installs still use --py-files).
from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """SNK-1."""
    w = df.write.mode(mode).option("header", True)
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SNK-2."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ---------------------------------------------------------------- Feather (SNK-3)
@dataclass
class _Written(WriterCommitMessage):
    tmp: str
    final: str


class _FeatherWriter(DataSourceArrowWriter):
    """Tasks write ``.part-<pid>-<uuid>.tmp`` through ``pyarrow.fs`` (local,
    HDFS or object stores); the driver renames them on commit and removes
    them on abort, so a retried task never leaves a second file."""

    def __init__(self, path: str, overwrite: bool, schema=None):
        self.path, self.overwrite, self.schema = path, overwrite, schema

    def write(self, iterator: Iterator) -> _Written:
        import pyarrow.fs as pafs
        import pyarrow.ipc as ipc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        fs, base = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(base, recursive=True)
        tmp = f"{base}/.part-{pid:05d}-{uuid.uuid4().hex}.tmp"
        writer = None
        with fs.open_output_stream(tmp) as out:
            for batch in iterator:
                if writer is None:
                    writer = ipc.new_file(out, batch.schema)
                writer.write_batch(batch)
            if writer is None:
                if pid:
                    out.close()
                    fs.delete_file(tmp)
                    return _Written("", "")
                # the first task always leaves a file, so an empty table can be read back
                from pyspark.sql.pandas.types import to_arrow_schema
                writer = ipc.new_file(out, to_arrow_schema(self.schema))
            writer.close()
        return _Written(tmp, f"{base}/part-{pid:05d}-{uuid.uuid4().hex[:8]}.feather")

    def _fs(self):
        import pyarrow.fs as pafs
        return pafs.FileSystem.from_uri(self.path)[0]

    def commit(self, messages) -> None:
        import pyarrow.fs as pafs
        fs = self._fs()
        base = pafs.FileSystem.from_uri(self.path)[1]
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if i.base_name.endswith(".feather")]
        for m in messages:      # the new parts first: a driver lost in between leaves old and new, never neither
            if m and m.tmp:
                fs.move(m.tmp, m.final)
        for path in old if self.overwrite else ():
            fs.delete_file(path)

    def abort(self, messages) -> None:
        import pyarrow.fs as pafs
        fs = self._fs()
        for m in messages:
            if m and m.tmp and fs.get_file_info(m.tmp).type != pafs.FileType.NotFound:
                fs.delete_file(m.tmp)


class FeatherDataSource(DataSource):
    """``df.write.format("panelspark_feather").save(path)``: one Arrow file
    per partition, renamed into place on job commit."""

    @classmethod
    def name(cls) -> str:
        return "panelspark_feather"

    def writer(self, schema, overwrite: bool):
        return _FeatherWriter(self.options["path"], overwrite, schema)


def write_feather(df: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-3: one Feather file per partition (paths on a shared file system)."""
    df.sparkSession.dataSource.register(FeatherDataSource)
    path = path if "://" in path else os.path.abspath(path)     # pyarrow.fs needs an absolute path or a URI
    df.write.format("panelspark_feather").mode(mode).save(path)


# ---------------------------------------------------------------- cross-sections (SNK-4, SNK-5)
def cross_sections(conv: Converted) -> DataFrame:
    """Wide rows (date, stock, f1..fk) of a converted panel, reindexed to
    every kept stock where the layout says so (PAN-7, PAN-8).

    A panel with ``value_text`` (layouts read from files) keeps factors that
    hold text as text columns, all others as numbers.  More factors than
    ``panel.pivot_limit`` become maps (``panel.packed_cross_section``).
    """
    if conv.factors.distinct().count() > P.pivot_limit(conv.factors):
        return _packed(conv)
    factors = P.pivot_values(conv.factors)
    panel, as_text = conv.panel, set()
    if "value_text" in panel.columns:
        as_text = {r["value"] for r in factor_types(conv).collect()} & set(factors)     # of the size-checked axis
        if as_text:
            panel = panel.withColumn("value", F.col("value_text"))
        panel = panel.drop("value_text")
    if conv.dense:
        dates = P.materialize(panel.select(F.col("date").alias("value")).distinct())
        wide = P.dense_cross_section(panel, factors, dates, conv.stocks)
    else:
        wide = P.cross_section(panel, factors)
    if not as_text:
        return wide
    return wide.select("date", "stock", *[(F.col(f"`{c}`") if c in as_text else F.col(f"`{c}`").cast("double")).alias(c)
                                          for c in factors])


def factor_types(conv: Converted) -> DataFrame:
    """The factors that hold text (column ``value``), decided once over all cells of a factor."""
    if "value_text" not in conv.panel.columns:
        return conv.panel.sparkSession.createDataFrame([], "value string")
    return P.text_factors(conv.panel)


def _packed(conv: Converted) -> DataFrame:
    panel = conv.panel
    if "value_text" in panel.columns:
        panel = P.typed(panel, P.materialize(factor_types(conv)))
    wide = P.packed_cross_section(panel)
    if not conv.dense:
        return wide
    dates = P.materialize(panel.select(F.col("date").alias("value")).distinct())
    out = P.reindex_dense(wide, dates, conv.stocks)
    empty = {c: F.create_map().cast(dict(wide.dtypes)[c]) for c in ("numbers", "texts")}
    return out.select("date", "stock", *[F.coalesce(F.col(c), e).alias(c) for c, e in empty.items()])


def write_cross_sections(conv: Converted, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SNK-4: one folder per date, ``date=YYYY-MM-DD``.

    Range partitioning on (date, stock) keeps tasks even when one date is
    much larger than the others (a hot date spans several tasks and files),
    and leaves every file sorted by stock.
    """
    wide = cross_sections(conv).withColumn("date", format_date("date"))
    if fmt != "parquet":        # CSV and Feather hold the maps as JSON
        wide = wide.select(*[F.to_json(F.col(f"`{c}`")).alias(c) if t.startswith("map<") else F.col(f"`{c}`") for c, t in wide.dtypes])
    n = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = wide.repartitionByRange(n, "date", "stock").sortWithinPartitions("date", "stock")
    w = out.write.mode(mode).partitionBy("date")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "feather":      # one table sorted by (date, stock), the date a column
        write_feather(out, path, mode)
    else:
        w.format(fmt).save(path)


def manifest(conv: Converted, layout: int, input_path: str, output_path: str, input_format: str,
             output_format: str) -> DataFrame:
    """SNK-5 content: one row with the sorted axes as arrays.

    The manifest is one JSON document by definition; its arrays are the
    axes (dates, stocks, factors), bounded by the panel's label counts, and
    ``text_factors``, the factors whose cells are text (the type is the
    factor's, not the cell's).  One aggregation over the stacked axes builds all.
    """
    from panelspark.operators.align import axis_table
    axes = axis_table(conv.dates, conv.stocks, conv.factors)
    axes = axes.unionByName(factor_types(conv).select(F.lit("text_factors").alias("dim"), "value"))

    def arr(dim):
        return F.sort_array(F.collect_set(F.when(F.col("dim") == dim, F.col("value")))).alias(dim)

    return axes.agg(F.lit(layout).alias("raw_data_format_type"), F.lit(input_path).alias("input_path"),
                    F.lit(output_path).alias("output_path"), F.lit(input_format).alias("input_file_format"),
                    F.lit(output_format).alias("output_file_format"), arr("dates"), arr("stocks"), arr("factors"), arr("text_factors"))


def write_manifest(conv: Converted, path: str, config_json: str | None = None, **meta) -> None:
    """SNK-5: the manifest as a Spark JSON folder at ``path`` (read back by
    ``readers.read_manifest``) and, with ``config_json``, also as the single
    JSON document the reference writes (``config.json``).  The manifest is
    one row, so the copy is one small file moved by ``pyarrow.fs``."""
    m = manifest(conv, **meta)
    m.coalesce(1).write.mode("overwrite").json(path)
    if config_json:
        import pyarrow.fs as pafs
        fs, base = pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
        part = [i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.base_name.startswith("part-")]
        _, target = pafs.FileSystem.from_uri(config_json if "://" in config_json else os.path.abspath(config_json))
        fs.copy_file(part[0], target)


# ---------------------------------------------------------------- holdings (SNK-6..8)
def write_baskets(baskets: DataFrame, path: str, holder: str = "ShareHolderID", date: str = "EndDate",
                  per_holder: bool = False, fmt: str = "csv", mode: str = "overwrite") -> None:
    """SNK-6: baskets clustered by holder, rows in date order.

    Default: one table, range-partitioned on (holder, date) and sorted, so a
    holder's rows are contiguous and in date order.  ``per_holder=True``
    writes the reference's one-folder-per-holder export (``holder=<id>``);
    it makes a folder per holder, so keep it for exports.
    """
    n = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = baskets.repartitionByRange(n, holder, date).sortWithinPartitions(holder, date)
    w = out.write.mode(mode)
    if per_holder:
        w = w.partitionBy(holder)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def csv_bytes(df: DataFrame) -> int:
    """Bytes of all rows as CSV lines, quoting and encoding included."""
    line = F.octet_length(F.to_csv(F.struct(*[F.col(c) for c in df.columns]))) + 1
    return int(df.agg(F.coalesce(F.sum(line.cast("long")), F.lit(0))).first()[0])


def cut_by_bytes(df: DataFrame, cap: int, order: list[str] | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``_file``, the number of the file a row falls into, and ``_row``, its
    place in ``order`` (all columns, if not given), and the number of files.

    A row's file is the running total of the bytes before it, divided by the cap:
    totals per range partition give offsets, a window adds up within a
    partition, so no file passes the cap by more than its last row."""
    columns = df.columns
    line = (F.octet_length(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]))) + 1).cast("long")
    keys = [F.col(f"`{c}`") for c in order or []] + [F.col(f"`{c}`").cast("string") if t.startswith("map<") else F.col(f"`{c}`")
                                                    for c, t in df.dtypes if c not in (order or [])]
    placed = sorted_tagged(df.withColumn("_bytes", line), keys)
    part = placed.groupBy("_pid").agg(F.sum("_bytes").alias("_sum"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))      # a row per partition
    here = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_off") + F.coalesce(F.sum("_bytes").over(here), F.lit(0))
    rows = placed.join(F.broadcast(part), "_pid").withColumn("_file", (start / cap).cast("long")).withColumn("_row", F.col("_mid"))
    whole = placed.agg(F.sum("_bytes").alias("all"), F.max_by("_bytes", F.struct("_pid", "_mid")).alias("last")).first()
    rows = rows.select(*[F.col(f"`{c}`") for c in columns], "_file", "_row")
    return rows, 1 if whole["all"] is None else int((whole["all"] - whole["last"]) // cap) + 1


def write_merged(df: DataFrame, path: str, max_file_size_mb: float = 100, filter_func=None,
                 mode: str = "overwrite", order: list[str] | None = None) -> int:
    """SNK-7: CSV files cut at ``max_file_size_mb``, rows in order.

    Rows are ordered by ``order`` (then by all other columns, so two runs give
    equal files), and a new file begins where the bytes so far reach the
    cap; file ``k`` is partition ``k``.  Returns the number of files (rows larger
    than the cap leave numbers without a file behind them).
    """
    out = df.transform(filter_func) if filter_func else df
    rows, n_files = cut_by_bytes(out, max(1, int(max_file_size_mb * 1024 * 1024)), order)
    rows = rows.repartitionById(n_files, F.col("_file").cast("int")).sortWithinPartitions("_file", "_row")
    rows.drop("_file", "_row").write.mode(mode).option("header", True).csv(path)
    return n_files


def write_dimensions(holders: DataFrame, industries: DataFrame, out_dir: str) -> None:
    """SNK-8: ``shareholders.csv`` and ``stock_industries.csv`` (folders)."""
    write_csv(holders, os.path.join(out_dir, "shareholders.csv"))
    write_csv(industries, os.path.join(out_dir, "stock_industries.csv"))


# ---------------------------------------------------------------- vectors, vocabulary (SNK-9, SNK-10)
def write_w2v_text(vectors: DataFrame, path: str, order_col: str | None = None) -> None:
    """SNK-9: word2vec text format: ``n dim``, then ``token v1 ... vd``.

    The line order is the vocabulary index: ``order_col``, else the column
    ``index`` if there is one, else the rows' own order.  The header is a
    row ordered before all vectors in a range-partitioned sort, so it is the
    first line of the first part file.
    """
    order_col = order_col or ("index" if "index" in vectors.columns else None)
    n = vectors.select(F.count(F.lit(1))).scalar()
    dim = vectors.select(F.max(F.size("vector"))).scalar()
    key = (F.col(order_col) if order_col else F.monotonically_increasing_id()).cast("double")
    lines = vectors.select(key.alias("_k"), F.col("token").alias("_t"),
                           F.concat_ws(" ", F.col("token"), F.array_join(
                               F.transform("vector", lambda x: x.cast("string")), " ")).alias("value"))
    spark = vectors.sparkSession
    header = spark.range(1).select(F.lit(-1.0).alias("_k"), F.lit("").alias("_t"),
                                   F.concat_ws(" ", n.cast("string"), dim.cast("string")).alias("value"))
    header.unionByName(lines).orderBy("_k", "_t").select("value").write.mode("overwrite").text(path)


def write_vocab_json(vocab: DataFrame, path: str, reverse_path: str | None = None) -> None:
    """SNK-10: token -> index, one JSON object per token, and at
    ``reverse_path`` index -> token, in index order."""
    vocab.select("token", "index").write.mode("overwrite").json(path)
    if reverse_path:
        vocab.select("index", "token").orderBy("index").write.mode("overwrite").json(reverse_path)


def read_json_lines(path: str) -> list[dict]:
    """Small helper for tests: read a folder of JSON-lines parts."""
    rows = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f), encoding="utf-8") as fh:
                rows.extend(json.loads(line) for line in fh if line.strip())
    return rows
