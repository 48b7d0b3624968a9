"""Helpers shared by the operators of this folder.

* ``ship`` pickles a module's functions by value, so executors need no copy
  of this package.
* ``worker_state`` keeps an object (a tokenizer, a bounded cache) for the
  life of a Python worker; it only saves time, never changes results.
* ``release`` gives a task's freed memory back.
* ``stage`` writes a table once to the shared folder of
  ``spark.checkpoint.dir`` and reads it back, so that later jobs neither
  recompute it nor depend on an executor that may be gone.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from panelspark.session import scratch_path


def ship(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def worker_state(key, make):
    """The object kept under ``key`` in this Python worker (made once)."""
    import types
    holder = sys.modules.setdefault("_worker_state_holder", types.ModuleType("_worker_state_holder"))
    items = holder.__dict__.setdefault("items", {})
    if key not in items:
        items[key] = make()
    return items[key]


def release() -> None:
    """Give freed memory of this Python worker back to the system: workers outlive their tasks."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once under the shared folder; read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_slices(batch: pa.RecordBatch, column: int, limit: int):
    """Cut a batch into runs of rows with about ``limit`` text bytes each.

    A single longer text stays whole; nulls count as empty.
    """
    if batch.num_rows == 0:
        return
    lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(lens) - lens) // limit
    cuts = np.flatnonzero(np.diff(run)) + 1
    start = 0
    for end in [*cuts.tolist(), batch.num_rows]:
        yield batch.slice(start, end - start)
        start = end


def ragged(offsets_from: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ranges ``[o, o + n)`` as one index array."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(offsets_from - (ends - lengths), lengths)
