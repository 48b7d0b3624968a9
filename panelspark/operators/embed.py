"""Asset embeddings (EMB-1..5).

EMB-1 trains skip-gram vectors with Spark ML's ``Word2Vec``.  It differs
from the reference's trainer: Spark uses hierarchical softmax (no negative
sampling, so ``negative`` has no counterpart), its vocabulary and vectors
live on the driver during training, several times over, and more partitions
change the result.  A vocabulary too large for that is trained by
``skipgram.train_skipgram`` (the reference's negative sampling), whose vectors
never meet on the driver.  It is checked for shape and neighbourhoods, not equality.

EMB-3..5 build the embedding matrix as a table ``(index, vector
ARRAY<DOUBLE>)``: the V trained rows in vocabulary order, then the special
rows.  Column means and cell statistics are grouped aggregates over
exploded cells (one group per dimension), never a matrix on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.rand import normal
from panelspark.operators.scratch import staged
from panelspark.operators.skipgram import train_skipgram


def train_word2vec(sent: DataFrame, col: str = "tokens", vector_size: int = 100, window: int = 5,
                   min_count: int = 1, max_iter: int = 10, seed: int = 42, num_partitions: int | None = None,
                   step_size: float = 0.025, max_sentence_length: int | None = None,
                   sentences_per_partition: int = 250_000, driver_budget_mb: int = 64):
    """EMB-1: fit Word2Vec; returns (model, vectors (token, vector ARRAY<DOUBLE>)).

    Spark trains one model per partition and averages them each pass.  The
    number of partitions comes from the data (the reference's 4 workers, and
    one for every ``sentences_per_partition``), the sentence length from the
    longest one, so none is cut.  A vocabulary whose two vector tables
    exceed ``driver_budget_mb`` (Spark's model holds them on the driver about
    five times over: sums, partitions' results, the model's copies) is trained in
    blocks on the executors instead, with the same settings; ``model`` is then None.
    """
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    sent = staged(sent.select(col), "word2vec-sentences")       # read by the counts and the training
    tokens = sent.select(F.explode(col).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= min_count).count()
    if 2 * 4 * tokens * vector_size > driver_budget_mb << 20:
        return None, train_skipgram(sent, col, vector_size=vector_size, window=window, min_count=min_count, epochs=max_iter,
                                    seed=seed, alpha=step_size)
    size = sent.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size(col)), F.lit(0)).alias("longest")).first()
    num_partitions = num_partitions or max(4, -(-size["n"] // sentences_per_partition))
    max_sentence_length = max_sentence_length or max(1, size["longest"])
    w2v = Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=max_iter, seed=seed,
                   numPartitions=num_partitions, stepSize=step_size, maxSentenceLength=max_sentence_length,
                   inputCol=col, outputCol="_avg")
    model = w2v.fit(sent.select(col))
    vectors = model.getVectors().select(F.col("word").alias("token"), vector_to_array("vector").alias("vector"))
    return model, vectors


def vector_of(vectors: DataFrame, token: str) -> DataFrame:
    """EMB-2: the vector of one token (zero or one row)."""
    return vectors.filter(F.col("token") == token)


def embedding_matrix(vocab: DataFrame, vectors: DataFrame, seed: int = 42, vector_col: str = "vector",
                     join_on: str = "raw") -> DataFrame:
    """EMB-3/4/5: rows 0..V-1 from the vectors in vocabulary order, then

    * V+3 ([CLS]) = row 0 and V+4 ([SEP]) = row 1 (the marker rows),
    * V+1 ([PAD]) = zeros,
    * V   ([MASK]) = column mean of the matrix as it stands then, i.e.
      (sum of V rows + row 0 + row 1) / (V + 5),
    * V+2 ([UNK]) = normal draws with the mean and population std of all
      cells at that point (the [UNK] row itself still zero).

    ``vocab`` is the table of ``corpus.vocabulary`` (``join_on='raw'``
    joins vectors on the trained token) or any (token, index) table with V
    rows (``join_on='token'``).  A vocabulary token without a vector raises.
    """
    core = vocab.filter(F.col("index").isNotNull())
    if "raw" in core.columns:
        core = core.filter(F.col("raw").isNotNull())
    found = vectors.select(F.col("token").alias("_k"), F.col(vector_col).cast("array<double>").alias("_v"))
    missing = F.raise_error(F.concat(F.lit("vocabulary token without a vector: "), F.coalesce("_k", F.lit("null"))))
    rows = (core.select(F.col(join_on).alias("_k"), "index").join(found, "_k", "left")
            .select("index", F.coalesce("_v", missing.cast("array<double>")).alias("vector")))
    v_count = core.select(F.count(F.lit(1))).scalar()      # V is the vocabulary's size, not that of the match
    first_two = rows.filter(F.col("index") < 2)
    cells = rows.select("index", F.posexplode("vector").alias("pos", "x"))
    # per dimension: sum over V rows, plus the copies of rows 0 and 1
    per_dim = cells.groupBy("pos").agg(F.sum("x").alias("s"), F.sum(F.when(F.col("index") < 2, F.col("x"))).alias("s01"),
                                       F.sum(F.col("x") * F.col("x")).alias("q"),
                                       F.sum(F.when(F.col("index") < 2, F.col("x") * F.col("x"))).alias("q01"))
    n_rows = v_count + 5
    per_dim = per_dim.withColumn("mask_x", (F.col("s") + F.coalesce(F.col("s01"), F.lit(0.0))) / n_rows)
    # cell statistics over the (V+5) x d matrix with [MASK] filled, [UNK] zero
    tot = per_dim.agg(
        F.sum(F.col("s") + F.coalesce(F.col("s01"), F.lit(0.0)) + F.col("mask_x")).alias("S"),
        F.sum(F.col("q") + F.coalesce(F.col("q01"), F.lit(0.0)) + F.col("mask_x") * F.col("mask_x")).alias("Q"),
        F.count(F.lit(1)).alias("d"))
    n_cells = F.col("d") * n_rows
    stats = tot.select((F.col("S") / n_cells).alias("mu"),
                       F.sqrt(F.greatest(F.col("Q") / n_cells - (F.col("S") / n_cells) ** 2, F.lit(0.0))).alias("sd"),
                       F.col("d"))
    mask_vec = per_dim.agg(F.sort_array(F.collect_list(F.struct("pos", "mask_x"))).alias("_m")).select(
        F.transform("_m", lambda e: e["mask_x"]).alias("vector"))
    mask_row = mask_vec.select((F.lit(v_count)).cast("long").alias("index"), "vector")
    pad_row = stats.select((F.lit(v_count) + 1).cast("long").alias("index"),
                           F.array_repeat(F.lit(0.0), F.col("d").cast("int")).alias("vector"))
    unk_row = stats.select((F.lit(v_count) + 2).cast("long").alias("index"), F.transform(
        F.sequence(F.lit(0), F.col("d").cast("int") - 1),
        lambda p: normal(seed, "unk", p, mean=F.col("mu"), std=F.col("sd"))).alias("vector"))
    copies = first_two.select((F.col("index") + F.lit(v_count) + 3).cast("long").alias("index"), "vector")
    return (rows.select(F.col("index").cast("long").alias("index"), "vector")
            .unionByName(mask_row).unionByName(pad_row).unionByName(unk_row).unionByName(copies))
