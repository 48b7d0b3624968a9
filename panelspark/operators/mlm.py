"""Masked-token training rows (MLM-1..11).

One DataFrame plan: tokens -> ids (broadcast vocabulary join on exploded
tokens, regrouped per row) -> cut to ``max_length`` -> pad -> attention
mask -> special-token flags -> seeded masking.  Every random choice is a
hash of (seed, stream, row key, position), so a row's masks do not depend
on partitioning or retries and DuckDB can recompute them.

Defaults follow the reference's code, not its comments: chosen positions
become ``[MASK]`` and 10 % of those a random id (90/10/0).

Scale notes: the vocabulary is broadcast only after a size check (it is
bounded by the number of listed securities); the regroup is per row, so a
group holds at most ``max_length`` tokens; when the input comes straight
from ``baskets`` it is already partitioned by the row key and the regroup
adds no shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.rand import digest, feistel, uniform, uniform_at
from panelspark.operators.corpus import CLS, MASK, PAD, SEP, UNK
from panelspark.operators.indexing import bucket_index, copies, distinct_rows, global_index

IGNORE_LABEL = -100
DEFAULT_MAX_VOCAB_BROADCAST = 5_000_000


def _lookup_table(vocab: DataFrame, max_broadcast: int) -> DataFrame:
    """Sentence token -> id.  Sentence markers are the added [CLS]/[SEP]."""
    t = vocab.select(F.col("token").alias("_tok"), F.col("index").cast("int").alias("_id"))
    n = vocab.count()
    return F.broadcast(t) if n <= max_broadcast else t


def vocab_info(vocab: DataFrame) -> dict[str, int]:
    """Ids of the five special tokens and the vocabulary length (V + 5).

    One small aggregate job; the result is six integers.
    """
    sp = F.col("raw").isNull()
    row = vocab.agg(F.count(F.lit(1)).alias("vocab_len"),
                    *[F.max(F.when(sp & (F.col("token") == t), F.col("index"))).alias(n)
                      for t, n in [(MASK, "mask_id"), (PAD, "pad_id"), (UNK, "unk_id"), (CLS, "cls_id"),
                                   (SEP, "sep_id")]]).first()
    info = {k: int(v) for k, v in row.asDict().items() if v is not None}
    missing = {"mask_id", "pad_id", "unk_id", "cls_id", "sep_id"} - set(info)
    if missing:
        raise ValueError(f"vocabulary lacks special tokens: {sorted(missing)}")
    return info


def token_ids(sent: DataFrame, keys: Sequence[str], vocab: DataFrame, col: str = "tokens",
              max_length: int | None = None, max_broadcast: int = DEFAULT_MAX_VOCAB_BROADCAST,
              info: dict[str, int] | None = None) -> DataFrame:
    """MLM-1 (+MLM-2): ids per row, unknown -> [UNK]; cut from the right.

    The cut happens before the lookup (one token = one id), so a long row
    loses its [SEP], as the reference's tokenizer does.
    """
    toks = F.slice(col, 1, max_length) if max_length else F.col(col)
    # rows are told apart by their content and its number of copies: two rows
    # of one key stay two rows, whatever order a task meets them in
    rows = distinct_rows(sent.select(*keys, toks.alias("_toks")), keys, "_toks")
    long = rows.select(*keys, "_h1", "_h2", "_n", F.posexplode("_toks").alias("_pos", "_tok"))
    lk = _lookup_table(vocab, max_broadcast)
    info = info or vocab_info(vocab)
    j = long.join(lk, "_tok", "left").withColumn("_id", F.coalesce(F.col("_id"), F.lit(info["unk_id"])))
    whole = j.groupBy(*keys, "_h1", "_h2").agg(F.sort_array(F.collect_list(F.struct("_pos", "_id"))).alias("_p"), F.max("_n").alias("_n"))
    return copies(whole.select(*keys, F.transform("_p", lambda x: x["_id"]).alias("input_ids"), "_n"))


def training_rows(sent: DataFrame, keys: Sequence[str], vocab: DataFrame, max_length: int = 20,
                  mask_prob: float = 0.15, mask_token_prob: float = 1.0, random_prob: float = 0.1,
                  seed: int = 42, col: str = "tokens",
                  max_broadcast: int = DEFAULT_MAX_VOCAB_BROADCAST) -> DataFrame:
    """MLM-8: keys + input_ids, attention_mask, labels (ARRAY<INT>, fixed length).

    ``mask_token_prob``: share of chosen positions set to [MASK] (1.0 in the
    reference's code); then ``random_prob`` of chosen positions get a
    random id in [0, V+5).
    """
    from panelspark.operators.panel import materialize
    vocab = materialize(vocab)              # read three times
    info = vocab_info(vocab)
    ids = token_ids(sent, keys, vocab, col, max_length, max_broadcast, info)
    vocab_len, pad_id, mask_id = info["vocab_len"], F.lit(info["pad_id"]), F.lit(info["mask_id"])
    specials = F.array(*[F.lit(info[c]) for c in ("cls_id", "sep_id", "mask_id", "pad_id", "unk_id")])
    # Padding positions hold [PAD], a special token, so they are never
    # chosen: mask the real positions only, then pad (MLM-3/4) both arrays.
    # One md5 per (row, position) gives the four draws: choose, [MASK] or
    # not, random replacement, random id.  The digests are computed in their
    # own array first, so the masking lambda reads them instead of hashing
    # again for every reference.
    hashed = ids.select(*keys, F.transform("input_ids", lambda x, i: F.struct(
        x.alias("x"), digest(seed, "mlm", *keys, i).alias("h"))).alias("_d"))

    def step(e):
        x, h = e["x"], e["h"]
        chosen = (~F.array_contains(specials, x)) & (uniform_at(h, 0) < mask_prob)         # MLM-5/6
        masked = F.when(chosen & (uniform_at(h, 1) < mask_token_prob), mask_id).otherwise(x)  # MLM-7
        rid = F.floor(uniform_at(h, 3) * vocab_len).cast("int")
        inp = F.when(chosen & (uniform_at(h, 2) < random_prob), rid).otherwise(masked)
        return F.struct(inp.alias("i"), F.when(chosen, x).otherwise(F.lit(IGNORE_LABEL)).alias("l"))

    steps = hashed.select(*keys, F.transform("_d", step).alias("_s"))
    n = F.size("_s")
    fill = F.greatest(F.lit(max_length) - n, F.lit(0))
    return steps.select(
        *keys,
        F.concat(F.transform("_s", lambda e: e["i"]), F.array_repeat(pad_id, fill)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), fill)).alias("attention_mask"),
        F.concat(F.transform("_s", lambda e: e["l"]), F.array_repeat(F.lit(IGNORE_LABEL), fill)).alias("labels"))


def rows_per_file(df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """MLM-9: rows per file (the dataset length is their sum)."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))


def file_offsets(per_file: DataFrame, file_col: str = "file_name") -> DataFrame:
    """MLM-10 part 1: cumulative start offset per file (files in name order).

    A table of one row per file: the window runs over #files rows only.
    """
    w = Window.orderBy(file_col).rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select(file_col, "n_rows", F.coalesce(F.sum("n_rows").over(w), F.lit(0)).alias("offset"))


def locate(indexes: DataFrame, offsets: DataFrame, idx_col: str = "idx", file_col: str = "file_name",
           max_buckets: int = 1_000_000, max_broadcast: int = DEFAULT_MAX_VOCAB_BROADCAST) -> DataFrame:
    """MLM-10 part 2: global index -> (file, line) where
    ``offset <= idx < offset + n_rows``.  Out-of-range indexes get nulls.

    A range join as an equi-join: indexes fall into buckets of width
    ``B = ceil(total / max_buckets)``; each file's range is exploded into
    the buckets it covers (at most ``max_buckets + #files`` rows, broadcast
    while that is under ``max_broadcast``), so every index meets at most a few candidate files
    instead of all of them.
    """
    total = int(offsets.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0])
    width = max(1, -(-total // max_buckets))
    o = offsets.filter(F.col("n_rows") > 0).select(
        F.col(file_col).alias("_f"), F.col("offset").alias("_o"), F.col("n_rows").alias("_n"))
    o = o.select("*", F.explode(F.sequence(F.floor(F.col("_o") / width),
                                           F.floor((F.col("_o") + F.col("_n") - 1) / width))).alias("_b"))
    keyed = indexes.withColumn("_b", F.floor(F.col(idx_col) / width))
    cond = ((keyed["_b"] == o["_b"]) & (F.col(idx_col) >= F.col("_o")) & (F.col(idx_col) < F.col("_o") + F.col("_n")))
    # at most max_buckets + #files rows; with more files than the bound the join shuffles
    small = offsets.count() + max_buckets <= max_broadcast
    j = keyed.join(F.broadcast(o) if small else o, cond, "left")
    return j.select(*indexes.columns, F.col("_f").alias(file_col), (F.col(idx_col) - F.col("_o")).alias("line"))


def shuffle_batches(rows: DataFrame, keys: Sequence[str], batch_size: int = 32, seed: int = 42,
                    shuffle: bool = True, num_partitions: int | None = None) -> DataFrame:
    """MLM-11: seeded shuffle, then fixed-size batches (last one short).

    Order = hash-uniform of the row key (ties by key), a global index over
    a range-partitioned sort, ``batch_id = floor(idx / batch_size)``.
    """
    order = ([uniform(seed, "shuffle", *keys)] if shuffle else []) + [F.col(k) for k in keys]
    indexed = global_index(rows, order, "sample_idx", num_partitions)
    return indexed.withColumn("batch_id", F.floor(F.col("sample_idx") / batch_size).cast("long"))


def permuted_batches(rows: DataFrame, keys: Sequence[str], batch_size: int = 32, seed: int = 42, buckets: int = 1_024) -> DataFrame:
    """MLM-11 without a sort or a copy of the rows: every row is numbered in place
    (``bucket_index``) and a keyed permutation of 0..n-1 turns its number into
    its place in the shuffled order; ``batch_id = floor(place / batch_size)``.

    Whole rows are shuffled once, by their keys' hash; only keys are counted.
    The order differs from ``shuffle_batches`` and is as fixed by the seed."""
    n = rows.count()
    if n == 0:
        return rows.withColumn("sample_idx", F.lit(None).cast("long")).withColumn("batch_id", F.lit(None).cast("long"))
    numbered = bucket_index(rows, keys, "_number", buckets)
    placed = numbered.withColumn("sample_idx", feistel(F.col("_number"), n, seed)).drop("_number")
    return placed.withColumn("batch_id", F.floor(F.col("sample_idx") / batch_size).cast("long"))
