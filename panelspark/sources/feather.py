"""Feather (Arrow IPC) files by record batch (SRC-3).

A Python data source: the footers give each file's schema and record batches,
and a partition is a range of batches of one file of about ``RANGE_BYTES``, so a
large file is read by many tasks and none holds a whole file (Feather files of
version 1 have no batches and stay whole).  Files may differ in schema: each is
projected on its own, as a table (columns by name, missing ones null), as
cells of a wide panel file, or as the columns of given roles.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package

RANGE_BYTES = 64 << 20
CELL_SCHEMA = "file_key string, row_label string, col_label string, value string"


def key_of(path: str, rule: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.split(".")[0] if rule == "first_dot" else name.rsplit(".", 1)[0]


def file_system(path: str):
    """(pyarrow file system, path in it) of a path or URI."""
    import os
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def feather_files(path: str) -> list[str]:
    import pyarrow.fs as pafs
    fs, base = file_system(path)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        return [path]
    prefix = path[:len(path) - len(base)] if path.endswith(base) and "://" in path else ""
    found = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.path.endswith(".feather"))
    return [prefix + p for p in found]


def open_feather(path: str):
    """(schema, number of record batches, bytes, reader of one batch) of a file."""
    import pyarrow as pa
    import pyarrow.feather as feather
    import pyarrow.ipc as ipc
    fs, base = file_system(path)
    fh = fs.open_input_file(base)
    try:
        f = ipc.open_file(fh)
    except pa.ArrowInvalid:                                     # version 1: a single block
        table = feather.read_table(fh).combine_chunks()
        return table.schema, 1, fh.size(), lambda k: table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)
    return f.schema, f.num_record_batches, fh.size(), f.get_batch


def merged_schema(files: list[str]):
    """Columns of all files by name; types that don't agree become text."""
    import pyarrow as pa
    fields: dict[str, pa.DataType] = {}
    for f in files:
        for x in open_feather(f)[0]:
            t = x.type.value_type if pa.types.is_dictionary(x.type) else x.type
            old = fields.setdefault(x.name, t)
            if old != t:
                try:
                    fields[x.name] = pa.unify_schemas([pa.schema([(x.name, old)]), pa.schema([(x.name, t)])], promote_options="permissive").field(0).type
                except (pa.ArrowTypeError, pa.ArrowInvalid):
                    fields[x.name] = pa.string()
    return pa.schema(list(fields.items()))


def as_text(column):
    """A column as text; days and timestamps at midnight as ``yyyy-mm-dd``."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if pa.types.is_dictionary(column.type):
        column = column.cast(column.type.value_type)
    if pa.types.is_timestamp(column.type) and pc.all(pc.equal(column, pc.floor_temporal(column, unit="day"))).as_py() is not False:
        column = column.cast(pa.date32(), safe=False)
    return column.cast(pa.string())


@dataclass
class BatchRange(InputPartition):
    path: str
    first: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, schema, path: str, spec: dict):
        self.schema, self.path, self.spec = schema, path, spec

    def partitions(self):
        out = []
        for f in feather_files(self.path):
            _, n, size, _ = open_feather(f)
            step = max(1, int(n * RANGE_BYTES // max(1, size)))
            out += [BatchRange(f, lo, min(lo + step, n)) for lo in range(0, n, step)]
        return out or [BatchRange("", 0, 0)]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        if not partition.path:
            return
        target = to_arrow_schema(self.schema)
        key = key_of(partition.path, self.spec["rule"])
        _, _, _, batch_at = open_feather(partition.path)
        for k in range(partition.first, partition.stop):
            yield from self._project(batch_at(k), key, target, pa)

    def _project(self, batch, key, target, pa):
        n = batch.num_rows
        if self.spec["kind"] == "cells":
            label = as_text(batch.column(0))
            for name, column in zip(batch.schema.names[1:], batch.columns[1:]):
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.string()), label, pa.array([name] * n, pa.string()), as_text(column)],
                                                 schema=target)
            return
        names = batch.schema.names
        if self.spec["kind"] == "roles":
            picked = {r: names[c] if isinstance(c, int) else c for r, c in self.spec["roles"].items()}
            lost = [c for c in picked.values() if c not in names]
            if lost:
                raise KeyError(f"columns {lost} not in {names} ({key})")
            columns = {r: as_text(batch.column(names.index(c))) for r, c in picked.items()}
        else:
            columns = {c: batch.column(names.index(c)) for c in target.names if c in names}
        columns["file_key"] = pa.array([key] * n, pa.string())
        out = []
        for f in target:
            c = columns.get(f.name)
            if c is None:
                c = pa.nulls(n, f.type)
            elif c.type != f.type:
                c = as_text(c) if pa.types.is_string(f.type) else (c.cast(c.type.value_type) if pa.types.is_dictionary(c.type) else c).cast(f.type)
            out.append(c)
        yield pa.RecordBatch.from_arrays(out, schema=target)


class FeatherBatches(DataSource):
    """``spark.read.format("panelspark_feather_batches")``: options ``path`` and ``spec`` (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "panelspark_feather_batches"

    def reader(self, schema):
        return _Reader(schema, self.options["path"], json.loads(self.options["spec"]))


def read_batches(spark: SparkSession, path: str, schema, kind: str, rule: str = "first_dot", roles: dict | None = None) -> DataFrame:
    """The files of ``path`` (one file or a folder) as ``table``, ``cells`` or ``roles``."""
    spark.dataSource.register(FeatherBatches)
    spec = json.dumps({"kind": kind, "rule": rule, "roles": roles or {}})
    return spark.read.format("panelspark_feather_batches").schema(schema).option("spec", spec).load(path)
