"""OP 1: token ids in rANS-coded files, in ascending document order.

A token file set is a folder with two Parquet tables:

* ``table``: id, frequency: the static model shared by all blocks, made from
  the counts of every id of the corpus (rows bounded by the vocabulary);
* ``blocks``: one row per independent block: its shard, its number and first
  token in the shard, the words, lane states and checkpoints of
  ``rans.encode``, the CRC-32 of words and ids, and its directory: the
  documents in it, the place of each piece in its document and the
  document's length.

Shards are ranges of the document id, so (shard, block) order is ascending
id order; the tokens before a shard follow from the block directory
(shards rows).  A block ends at a document's end where that fits; only a
document longer than a block is in several.

Null ids come first; equal ids are in order of a hash of their tokens; a
null or empty text is the end id alone; an empty table gives empty files.
Other columns of the input play no part.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm import rans
from panelspark.llm import word_tokens as WT
from panelspark.llm.common import byte_slices, partitions, ship, stage, worker_state
from panelspark.session import scratch_path

ship(__name__)

END_ID = 1
BLOCK_TOKENS = 1 << 18
GROUP_BLOCKS = 16          # blocks coded side by side in a task


def id_width(tokenizer_path: str | None, end_id: int) -> int:
    """Bytes per id in the staged rows: two where every id fits, else four."""
    spec = json.loads(WT.tokenizer_json(tokenizer_path))
    highest = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if highest < 1 << 16 else 4


def tokenize(df: DataFrame, id_col: str, text_col: str, end_id: int, tokenizer_path: str | None, width: int) -> DataFrame:
    """Staged rows: documents (id, n, ids) and, per task, its id counts."""
    src = df.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text_"))
    content = df.sparkSession.sparkContext.broadcast(WT.tokenizer_json(tokenizer_path))  # fixed size
    id_type = src.schema[0].dataType

    def task(batches):
        cache = WT.library_cache(content.value)
        counts = np.zeros(0, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in byte_slices(batch, 1, WT.SLICE_BYTES):
                ids, offsets = WT.with_end(*WT.encode_texts(part.column(1), cache), end_id)
                seen = np.bincount(ids)
                if len(seen) > len(counts):
                    counts = np.pad(counts, (0, len(seen) - len(counts)))
                counts[:len(seen)] += seen
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(offsets) - 1,
                    [None, pa.py_buffer((offsets * width).astype(np.int64).tobytes()), pa.py_buffer(ids.astype(f"<u{width}").tobytes())])
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)), raw.cast(pa.binary()),
                     pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))],
                    names=["id_", "n_", "ids_", "token_", "count_"])
        if kind is not None:
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([used]), pa.array([counts[used]])], names=["id_", "n_", "ids_", "token_", "count_"])

    return stage(src.mapInArrow(
        task, f"id_ {id_type.simpleString()}, n_ long, ids_ binary, token_ array<long>, count_ array<long>"), "tokens")


def cut_blocks(lengths: list[int], block: int) -> list[list[tuple[int, int, int]]]:
    """Pieces (document, start in it, length) per block."""
    blocks, now, room = [], [], block
    for d, n in enumerate(lengths):
        if n > room and now:
            blocks.append(now)
            now, room = [], block
        at = 0
        while n - at > block:
            blocks.append([(d, at, block)])
            at += block
        now.append((d, at, n - at))
        room -= n - at
    return blocks + [now] if now else blocks


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 tokenizer_path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text of ``df`` into a token file set at ``path``."""
    spark = df.sparkSession
    width = id_width(tokenizer_path, end_id)
    staged = tokenize(df, id_col, text_col, end_id, tokenizer_path, width)
    counts = (staged.filter("token_ is not null").select(F.explode(F.arrays_zip("token_", "count_")).alias("c"))
              .groupBy("c.token_").agg(F.sum("c.count_").alias("n")).toPandas())   # at most a row per vocabulary id
    if len(counts):
        table = rans.Table.scaled(counts["token_"].to_numpy(), counts["n"].to_numpy())
    else:
        table = rans.Table(np.zeros(1, np.uint32), np.array([1 << 20]), 20)
    spark.createDataFrame(pd.DataFrame({"token": table.ids.astype(np.int64), "freq": table.freq.astype(np.int64)}),
                          "token long, freq long").coalesce(1).write.parquet(f"{path}/table")
    model = spark.sparkContext.broadcast((table.ids, table.freq, table.bits))
    docs = (staged.filter("token_ is null").select("id_", "n_", "ids_", F.xxhash64("ids_").alias("tie_"))
            .repartitionByRange(partitions(spark), F.col("id_").asc_nulls_first(), F.col("tie_"))
            .sortWithinPartitions(F.col("id_").asc_nulls_first(), F.col("tie_")))
    id_type = staged.schema["id_"].dataType.simpleString()

    def task(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        model_ = rans.Table(*model.value)
        state = {"block": 0, "token": 0, "doc": 0}

        def flush(ids_of, raws, kind, keep):
            """Blocks of the documents held; with ``keep`` the last, unfilled one stays."""
            lengths = [len(r) // width for r in raws]
            blocks = cut_blocks(lengths, block_tokens)
            left = len(raws)
            if keep and blocks and blocks[-1][0][1] == 0:
                left = blocks.pop()[0][0]
            rows = []
            for k in range(0, len(blocks), GROUP_BLOCKS):
                group = blocks[k:k + GROUP_BLOCKS]
                flat = np.frombuffer(b"".join(raws[d][width * a:width * (a + n)] for b in group for d, a, n in b), f"<u{width}")
                sizes = np.array([sum(n for _, _, n in b) for b in group], np.int64)
                for b, n, coded in zip(group, sizes.tolist(), rans.encode(model_, flat, sizes)):
                    rows.append(coded | {
                        "shard": shard, "block": state["block"], "first_token": state["token"], "n_tokens": n,
                        "first_doc": state["doc"] + b[0][0], "doc_ids": [ids_of[d] for d, _, _ in b],
                        "doc_from": [a for _, a, _ in b], "doc_len": [m for _, _, m in b],
                        "doc_total": [lengths[d] for d, _, _ in b]})
                    state["block"] += 1
                    state["token"] += n
            state["doc"] += left
            return rows, ids_of[left:], raws[left:]

        def batch_of(rows, kind):
            fields = [("shard", pa.int32()), ("block", pa.int64()), ("first_token", pa.int64()), ("n_tokens", pa.int64()),
                      ("first_doc", pa.int64()), ("words", pa.binary()), ("states", pa.binary()), ("marks", pa.list_(pa.int64())),
                      ("words_crc32", pa.int64()), ("ids_crc32", pa.int64()), ("doc_ids", pa.list_(kind)),
                      ("doc_from", pa.list_(pa.int64())), ("doc_len", pa.list_(pa.int64())), ("doc_total", pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], t) for f, t in fields], names=[f for f, _ in fields])

        ids_of, raws, held, kind = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in byte_slices(batch, 2, width * block_tokens * GROUP_BLOCKS):
                ids_of += part.column(0).to_pylist()
                new = part.column(2).to_pylist()
                raws += new
                held += sum(map(len, new)) // width
                if held >= block_tokens * GROUP_BLOCKS:
                    rows, ids_of, raws = flush(ids_of, raws, kind, True)
                    held = sum(map(len, raws)) // width
                    if rows:
                        yield batch_of(rows, kind)
        if raws:
            yield batch_of(flush(ids_of, raws, kind, False)[0], kind)

    docs.mapInArrow(task, (
        "shard int, block long, first_token long, n_tokens long, first_doc long, words binary, states binary, "
        "marks array<long>, words_crc32 long, ids_crc32 long, "
        f"doc_ids array<{id_type}>, doc_from array<long>, doc_len array<long>, doc_total array<long>")
    ).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_pieces(spark: SparkSession, path: str, with_ids: bool = True, cut_only: bool = False) -> DataFrame:
    """Decode all blocks (``cut_only``: those with a piece of a longer
    document): one row per piece of a document in a block.

    Columns: id_, shard, doc (its number in the shard), from_, len_, total_,
    start (tokens of all documents before it), crc_ and, if asked for, ids.
    """
    table = spark.read.parquet(f"{path}/table").toPandas().sort_values("token")     # vocabulary rows
    bits = int(table["freq"].sum()).bit_length() - 1
    model = spark.sparkContext.broadcast((table["token"].to_numpy(), table["freq"].to_numpy(), bits))
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    wanted = blocks.filter(F.exists(F.zip_with("doc_len", "doc_total", lambda a, b: a < b), lambda x: x)) if cut_only else blocks

    def task(batches):
        table_ = rans.Table(*model.value)
        for batch in batches:
            for k in range(0, batch.num_rows, GROUP_BLOCKS):
                part = batch.slice(k, GROUP_BLOCKS)
                rows = part.select(["n_tokens", "words", "states", "marks", "words_crc32", "ids_crc32"]).to_pylist()
                ids = rans.decode(table_, rows)
                lens = part.column("doc_len")
                n = pc.list_value_length(lens).to_numpy()
                of = np.repeat(np.arange(part.num_rows), n)
                length = lens.flatten().to_numpy()
                from_ = part.column("doc_from").flatten().to_numpy()
                flat = np.concatenate(ids).astype("<u4").tobytes()
                ends = np.cumsum(length)
                view = memoryview(flat)
                cut = list(zip((4 * (ends - length)).tolist(), (4 * ends).tolist()))
                before = (ends - length) - np.array([0, *np.cumsum([len(x) for x in ids])[:-1]])[of]
                nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                at = part.column("first_token").to_numpy()[of] + before - from_
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_ids").flatten(), part.column("shard").take(pa.array(of)),
                    pa.array(part.column("first_doc").to_numpy()[of] + nth), pa.array(from_), pa.array(length),
                    part.column("doc_total").flatten(), pa.array(at),
                    pa.array([zlib.crc32(view[a:b]) for a, b in cut], pa.int64()),
                    pa.array([flat[a:b] for a, b in cut], pa.binary()) if with_ids else pa.nulls(len(of), pa.binary()),
                ], names=["id_", "shard", "doc", "from_", "len_", "total_", "at_", "crc_", "ids"])

    pieces = wanted.mapInArrow(task, f"id_ {id_type}, shard int, doc long, from_ long, len_ long, total_ long, "
                                     "at_ long, crc_ long, ids binary")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)      # one row per shard
    offs = (blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_"))
            .select("shard", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("off_")))
    return pieces.join(F.broadcast(offs), "shard").withColumn("start", F.col("off_") + F.col("at_")).drop("off_", "at_")


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Every document: id, ``start``, ``n_tokens`` and ``ids`` (little-endian
    uint32).  Only documents longer than a block are put together again."""
    p = read_pieces(spark, path)
    whole = p.filter("len_ = total_").select(F.col("id_").alias(id_col), "start", F.col("total_").alias("n_tokens"), "ids")
    cut = (read_pieces(spark, path, cut_only=True).filter("len_ < total_").groupBy("shard", "doc", "id_", "start", "total_")
           .agg(F.sort_array(F.collect_list(F.struct("from_", "ids"))).alias("p"))
           .select(F.col("id_").alias(id_col), "start", F.col("total_").alias("n_tokens"),
                   F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")))
    return whole.unionByName(cut)


def token_checksums(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Every document: id, ``start``, ``n_tokens``, ``ids_crc32``; pieces of a
    long document are combined by their checksums alone."""
    p = read_pieces(spark, path, with_ids=False)
    whole = p.filter("len_ = total_").select(F.col("id_").alias(id_col), "start", F.col("total_").alias("n_tokens"),
                                             F.col("crc_").alias("ids_crc32"))

    @F.pandas_udf("long")
    def combine(parts: pd.Series) -> pd.Series:
        return pd.Series([rans.crc32_combine([(x["crc_"], 4 * x["len_"]) for x in row]) for row in parts], dtype="int64")

    cut = (read_pieces(spark, path, with_ids=False, cut_only=True).filter("len_ < total_").groupBy("shard", "doc", "id_", "start", "total_")
           .agg(F.sort_array(F.collect_list(F.struct("from_", "crc_", "len_"))).alias("p"))
           .select(F.col("id_").alias(id_col), "start", F.col("total_").alias("n_tokens"), combine("p").alias("ids_crc32")))
    return whole.unionByName(cut)


def op1_rans_tokens(spark, sf_dir: str) -> DataFrame:
    """Every document tokenized, written to rANS files and read back."""
    path = scratch_path(spark, "token-files")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_checksums(spark, path)
