"""Token sentences, vocabulary and stock aliases (TOK-1..13).

A sentence is ``ARRAY<STRING>``: ``[CLS]``, the basket's ids zero-padded to
six, ``[SEP]``.  The vocabulary is a table ``(token, index, count)``.

Vocabulary rule (reference note 13, kept on purpose): vocabulary keys are
the trained tokens padded to six, so the markers become ``0[CLS]`` and
``0[SEP]`` (normally rows 0 and 1, the most frequent tokens); then
``[MASK] [PAD] [UNK]`` take indexes V..V+2 and the tokenizer's added
``[CLS] [SEP]`` take V+3 and V+4, which is what sentences are encoded with.

Scale notes: token counts are a grouped count (partial aggregation handles
the markers, which occur in every sentence); the frequency order is a
range-partitioned global index (``indexing.global_index``), so no single
task ranks the whole vocabulary.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.rand import uniform
from panelspark.functions.scalars import pad_id, parse_basket
from panelspark.operators.indexing import copies, distinct_rows, global_index

# Fixed values (tokenizer special tokens, in the reference's order).
CLS, SEP, MASK, PAD, UNK = "[CLS]", "[SEP]", "[MASK]", "[PAD]", "[UNK]"
APPENDED = [MASK, PAD, UNK]          # indexes V, V+1, V+2
ADDED = [CLS, SEP]                   # indexes V+3, V+4 (new tokens of the tokenizer)
SPECIALS = APPENDED + ADDED
N_SPECIAL = len(SPECIALS)


def sentences(baskets: DataFrame, text_col: str = "Holdings", keep: Sequence[str] = (),
              out: str = "tokens") -> DataFrame:
    """TOK-1/2/3: basket text -> [CLS] + padded ids + [SEP]; bad rows dropped.

    Use ``rejects`` for the rows that do not parse.
    """
    ids = parse_basket(text_col)
    sent = F.concat(F.array(F.lit(CLS)), F.transform(ids, lambda x: pad_id(x)), F.array(F.lit(SEP)))
    return (baskets.select(*keep, ids.alias("_ids"), sent.alias(out))
            .filter(F.col("_ids").isNotNull()).drop("_ids"))


def rejects(baskets: DataFrame, text_col: str = "Holdings") -> DataFrame:
    """Rows whose basket text does not parse (reported, not trained on)."""
    return baskets.filter(parse_basket(text_col).isNull())


def distinct_tokens(sent: DataFrame, col: str = "tokens") -> DataFrame:
    """TOK-4."""
    return sent.select(F.explode(col).alias("token")).distinct()


def token_counts(sent: DataFrame, col: str = "tokens", min_count: int = 1) -> DataFrame:
    """TOK-5: (token, count) with count >= min_count."""
    c = sent.select(F.explode(col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return c.filter(F.col("count") >= min_count)


def vocabulary(sent: DataFrame, col: str = "tokens", min_count: int = 1,
               num_partitions: int | None = None) -> DataFrame:
    """TOK-6/7/8: (token, raw, index, count), most frequent first, ties by
    padded token; then the five special tokens."""
    counts = token_counts(sent, col, min_count).select(pad_id("token").alias("token"), F.col("token").alias("raw"),
                                                        "count")
    core = global_index(counts, [F.col("count").desc(), F.col("token").asc(), F.col("raw").asc()], "index",
                        num_partitions)
    v = core.select(F.count(F.lit(1))).scalar()
    spark = sent.sparkSession
    specials = spark.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, _i int")
    specials = specials.select("token", F.lit(None).cast("string").alias("raw"),
                               (F.col("_i") + v).cast("long").alias("index"), F.lit(None).cast("long").alias("count"))
    return core.select("token", "raw", "index", "count").unionByName(specials)


def check_vocab_size(vocab: DataFrame, model_vocab_size: int) -> None:
    """TOK-9: V + 5 must equal the model's vocabulary size."""
    n = vocab.count()
    if n != model_vocab_size:
        raise ValueError(f"vocabulary size mismatch: {n} tokens (V+5) vs model {model_vocab_size}")


def subsample(sent: DataFrame, keys: Sequence[str], col: str = "tokens", sample: float = 1e-3,
              seed: int = 42, counts: DataFrame | None = None, max_broadcast: int = 5_000_000) -> DataFrame:
    """TOK-10: drop frequent tokens at random before training.

    A token with frequency f = count / total is kept with probability
    min(1, sqrt(t/f) + t/f), t = ``sample``; the draw is a hash of
    (seed, row keys, position).  Returns keys + the kept tokens in order, one
    row for each input row that keeps a token (two rows of one key stay two).
    """
    counts = counts if counts is not None else token_counts(sent, col)
    from panelspark.session import checkpoint_dir
    checkpoint_dir(sent.sparkSession)
    counts = counts.checkpoint()            # the token set, used three times
    total = counts.select(F.sum("count")).scalar()
    rows = distinct_rows(sent.select(*keys, F.col(col).alias("_toks")), keys, "_toks")      # rows by content: safe under a retry
    long = rows.select(*keys, "_h1", "_h2", "_n", F.posexplode("_toks").alias("pos", "token"))
    # the counts are one row a token; broadcast under the bound, so that a
    # token of every sentence (the markers) is no hot join key
    small = counts.count() <= max_broadcast
    j = long.join(F.broadcast(counts) if small else counts, "token")
    ratio = F.lit(sample) * total / F.col("count")
    keep_p = F.least(F.lit(1.0), F.sqrt(ratio) + ratio)
    kept = j.filter(uniform(seed, "subsample", *keys, "pos") < keep_p)
    whole = kept.groupBy(*keys, "_h1", "_h2").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_t"), F.max("_n").alias("_n"))
    return copies(whole.select(*keys, F.transform("_t", lambda x: x["token"]).alias(col), "_n"))


def alias_maps(alias: DataFrame, order: Column | str = "row_order") -> tuple[DataFrame, DataFrame]:
    """TOK-11: (name -> code) and (code -> name); the last row wins."""
    o = F.col(order) if isinstance(order, str) else order
    name2code = alias.filter(F.col("name").isNotNull()).groupBy("name").agg(F.max_by("code", o).alias("code"))
    code2name = alias.filter(F.col("code").isNotNull()).groupBy("code").agg(F.max_by("name", o).alias("name"))
    return name2code, code2name


def encode(texts: DataFrame, col: str, vocab: DataFrame, name2code: DataFrame, out: str = "id",
           max_broadcast: int = 5_000_000) -> DataFrame:
    """TOK-12: a stock given as code or name -> token index ([UNK] if unknown).

    Names become codes first (the reference turned codes into names, which
    the vocabulary does not hold).  Both small tables are materialized, counted
    and broadcast under the bound, so a name that fills a third of the texts is
    no hot join key; beyond it the tables are read as they are, which lets
    adaptive execution split a hot name's texts.
    """
    from panelspark.operators.panel import materialize
    name2code = materialize(name2code)
    vocab = materialize(vocab)
    unk = vocab.filter((F.col("token") == UNK) & F.col("raw").isNull()).select("index")
    n2c = name2code.withColumnRenamed("name", "_name").withColumnRenamed("code", "_code")
    t = texts.join(F.broadcast(n2c) if name2code.count() <= max_broadcast else n2c, F.col(col) == F.col("_name"), "left")
    t = t.withColumn("_tok", pad_id(F.coalesce(F.col("_code"), F.col(col))))
    v = vocab.filter(F.col("raw").isNotNull()).select(F.col("token").alias("_tok"), F.col("index").alias("_idx"))
    t = t.join(F.broadcast(v) if vocab.count() <= max_broadcast else v, "_tok", "left")
    return t.withColumn(out, F.coalesce(F.col("_idx"), unk.scalar())).drop("_name", "_code", "_tok", "_idx")


def decode(ids: DataFrame, col: str, vocab: DataFrame, code2name: DataFrame, mode: str = "id",
           out: str = "decoded") -> DataFrame:
    """TOK-13: index -> code (``mode='id'``) or its name (``mode='name'``,
    falling back to the code when the alias table lacks it)."""
    v = vocab.select(F.col("index").alias("_i"), F.col("token").alias("_tok"))
    t = ids.join(v, F.col(col) == F.col("_i"), "left")
    if mode == "name":
        c2n = code2name.withColumnRenamed("code", "_tok").withColumnRenamed("name", "_name")
        t = t.join(c2n, "_tok", "left").withColumn(out, F.coalesce(F.col("_name"), F.col("_tok"))).drop("_name")
    elif mode == "id":
        t = t.withColumn(out, F.col("_tok"))
    else:
        raise ValueError("mode is 'id' or 'name'")
    return t.drop("_i", "_tok")
