"""OP 9: packing by power-of-two decomposition.

A document of ``n`` tokens (end id included) is cut from its start into
``n // max_len`` pieces of ``max_len`` and one piece for each one-bit of the
rest, longest first.  Each piece is a sequence of its own, in the bucket of
its length: lengths are powers of two, so batches of one bucket need no
padding and no sequence crosses documents.

Pieces are numbered without gaps: bucket by bucket (longest first), and
within a bucket by (task, order in the task).  Every task counts its own
pieces; only those counts (tasks x buckets rows) are summed up and joined
back, so numbering moves no tokens.

Null and empty texts are one piece of the end id alone; an empty table
gives no rows; repeated rows are packed each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import word_tokens as WT
from panelspark.llm.common import byte_slices, ragged, ship, stage

ship(__name__)

MAX_LEN = 2048
END_ID = 1


def decompose(lengths: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner (index), start in the owner and length of every piece, in order."""
    bits = max_len.bit_length() - 1
    full = lengths >> bits
    owner, start, length = [np.repeat(np.arange(len(lengths)), full)], [], []
    start.append(ragged(np.zeros(len(lengths), np.int64), full) << bits)
    length.append(np.full(len(owner[0]), max_len, np.int64))
    at = full << bits
    for b in range(bits - 1, -1, -1):
        has = np.flatnonzero((lengths >> b) & 1)
        owner.append(has)
        start.append(at[has])
        length.append(np.full(len(has), 1 << b, np.int64))
        at[has] += 1 << b
    owner, start, length = map(np.concatenate, (owner, start, length))
    order = np.lexsort((start, owner))
    return owner[order], start[order], length[order]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: the id column, ``start``, ``length``, ``ids``
    (little-endian uint32), ``doc_tokens``, ``sequence_id``, ``offset``.

    The packed rows are written once to the shared folder and read back.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    src = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text_"))
    content = df.sparkSession.sparkContext.broadcast(WT.tokenizer_json(tokenizer_path))  # fixed size
    id_type = src.schema[0].dataType.simpleString()

    def task(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId()
        cache = WT.library_cache(content.value)
        seen = np.zeros(64, np.int64)
        for batch in batches:
            for part in byte_slices(batch, 1, WT.SLICE_BYTES):
                ids, offsets = WT.with_end(*WT.encode_texts(part.column(1), cache), end_id)
                total = np.diff(offsets)
                owner, start, length = decompose(total, max_len)
                bucket = np.log2(length).astype(np.int64)
                rank = np.empty(len(bucket), np.int64)
                for b in np.unique(bucket):
                    mine = np.flatnonzero(bucket == b)
                    rank[mine] = seen[b] + np.arange(len(mine))
                    seen[b] += len(mine)
                cuts = pa.array(np.append(offsets[owner] + start, offsets[-1]).astype(np.int64) * 4)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(owner)), pa.array(start), pa.array(length),
                    pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(owner), [None, cuts.buffers()[1], pa.py_buffer(ids.astype("<u4").tobytes())]).cast(pa.binary()),
                    pa.array(total[owner]), pa.array(bucket.astype(np.int32)),
                    pa.array(np.full(len(owner), number, np.int32)), pa.array(rank),
                ], names=[id_col, "start", "length", "ids", "doc_tokens", "bucket_", "task_", "rank_"])

    rows = stage(src.mapInArrow(
        task, f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, "
              "bucket_ int, task_ int, rank_ long"), "packed")
    counts = rows.groupBy("bucket_", "task_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy("bucket_").orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("bucket_").agg(F.sum("n_").alias("size_"))
    longer = Window.orderBy(F.desc("bucket_")).rowsBetween(Window.unboundedPreceding, -1)   # one row per bucket
    base = sizes.select("bucket_", F.coalesce(F.sum("size_").over(longer), F.lit(0)).alias("base_"))
    # tasks x buckets rows at most
    offs = (counts.withColumn("before_", F.coalesce(F.sum("n_").over(before), F.lit(0)))
            .join(F.broadcast(base), "bucket_")
            .select("bucket_", "task_", (F.col("base_") + F.col("before_")).alias("first_")))
    return rows.join(F.broadcast(offs), ["bucket_", "task_"]).select(
        id_col, "start", "length", "ids", "doc_tokens",
        (F.col("first_") + F.col("rank_")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def op9_pack(spark, sf_dir: str) -> DataFrame:
    """Every document packed; ids are given by their CRC-32."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                             "doc_tokens", "sequence_id", "offset")
