"""OP 4: document fingerprints by consistent weighted sampling, native.

A document's terms are its words (split at white space), weighted by their
counts.  For each of ``SAMPLES`` samples ``k`` a term ``x`` of weight ``w``
draws, from hashes of (x, k) alone,

    r, c ~ Gamma(2, 1),  b ~ U(0, 1),
    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1),

and the sample is the (x, t) of least ``a``.  Two documents take the same
sample with the probability of their generalised Jaccard similarity
(sum of smaller over sum of larger weights).  ``a`` is a function of
(x, t, k), so the least ``a`` itself names the sample; a fingerprint is 32
bits of its hash per sample, as hexadecimal digits, and the likeness of two
fingerprints the share of samples in which they agree.

Everything is built-in column expressions.  One shuffle deals the rows out
by ranges of the id; counting words, drawing samples and taking minima
all happen within those ranges, so words are never shuffled.  To find each
row's successor in descending id order, the last row of each range is dealt
to the next range too (as a guest), by its id: the range bounds are ids of rows.

Terms are told apart by 64-bit hashes.  Null and empty texts and those of
white space alone have no terms: their fingerprint is all zeros and
they are alike.  Null ids come after all others; equal ids are in order of a
hash of the text; a single row is its own successor; an empty table gives
no rows.  Ids must be numbers.  Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import partitions, ship

ship(__name__)

SAMPLES = 48
RANGES_PER_PARTITION = 4   # finer than the session's partitions: the word counts of a range stay in memory


def draws(term: Column, log_weight: Column, k: int) -> Column:
    """ln a of sample ``k`` for a term (a hash) and the logarithm of its weight."""
    u = F.xxhash64(term, F.lit(2 * k))
    v = F.xxhash64(term, F.lit(2 * k + 1))

    def uniform(h: Column, shift: int) -> Column:           # 21 bits, inside (0, 1)
        return (F.shiftright(h, shift).bitwiseAND(F.lit(0x1FFFFF)).cast("double") + 0.5) / float(1 << 21)

    r = -F.log(uniform(u, 0) * uniform(u, 21))              # Gamma(2, 1): the sum of two exponentials
    log_c = F.log(-F.log(uniform(v, 0) * uniform(v, 21)))
    b = uniform(v, 42)
    t = F.floor(log_weight / r + b).cast("double")
    return log_c - r * (t - b + 1.0)


def term_counts(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, term_ (hash of the word), log_w_; a text without words keeps one
    row with a null weight."""
    words = texts.select(*keys, F.explode_outer(F.split(F.col(text), r"\s+")).alias("word_"))
    return (words.select(*keys, F.xxhash64("word_").alias("term_"),
                         F.when(F.col("word_") != "", 1).otherwise(0).alias("one_"))
            .groupBy(*keys, "term_").agg(F.sum("one_").alias("w_"))
            .select(*keys, "term_", F.when(F.col("w_") > 0, F.log(F.col("w_").cast("double"))).alias("log_w_")))


def signatures(texts: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """keys and ``sig_`` (array<long>, 32 bits per sample) of every text."""
    least = [F.min(draws(F.col("term_"), F.col("log_w_"), k)).alias(f"m{k}_") for k in range(samples)]
    low = term_counts(texts, keys, text).groupBy(*keys).agg(*least)
    piece = [F.coalesce(F.when(F.col(f"m{k}_").isNotNull(), F.xxhash64(f"m{k}_").bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0).cast("long"))
             for k in range(samples)]
    return low.select(*keys, F.array(*piece).alias("sig_"))


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)).cast("double") / samples


def neighbours(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(g, rid, guest, id_, text_, next_): rows dealt out by ranges ``g`` of the id, in
    descending order ``rid`` within a range, with the next row's text."""
    rows = df.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_"))
    n = partitions(df.sparkSession) * RANGES_PER_PARTITION
    ends = rows.agg(F.percentile_approx("id_", [i / n for i in range(1, n)], 10_000).alias("q"), F.max("id_").alias("m")).first()
    bounds = sorted(set(ends["q"] or []))                   # fewer than n ids of rows
    edge = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<long>")
    g = F.coalesce(F.size(F.filter(edge, lambda b: b < F.col("id_"))), F.lit(0))
    g = F.when(F.col("id_").isNull(), 0).otherwise(g)
    places = F.array(F.struct(g.alias("g"), F.lit(False).alias("guest")))
    if ends["m"] is not None:
        if bounds and bounds[-1] != ends["m"]:
            last = len(bounds)
        else:
            last = len(bounds) - 1
        again = F.when(F.col("id_") == F.lit(ends["m"]), F.array(F.struct(F.lit(0).alias("g"), F.lit(True).alias("guest"))))
        if bounds:
            inner = F.array_contains(edge, F.col("id_")) & (g < last)
            again = again.when(inner, F.array(F.struct((g + 1).alias("g"), F.lit(True).alias("guest"))))
        places = F.concat(places, F.coalesce(again, F.array().cast("array<struct<g:int,guest:boolean>>")))
    dealt = (rows.select("id_", "text_", F.explode(places).alias("p_"))
             .select("id_", "text_", F.col("p_.g").alias("g"), F.col("p_.guest").alias("guest"))
             .repartitionById(n, F.col("g")))
    order = Window.partitionBy("g").orderBy("guest", F.col("id_").desc_nulls_last(), F.xxhash64("text_"))
    return dealt.select(
        "g", F.row_number().over(order).alias("rid"), "guest", "id_", "text_",
        F.coalesce(F.lead("text_").over(order), F.first("text_").over(order)).alias("next_")), n


def fingerprint_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is the text with its last ``n_chars // 2`` characters
    replaced by the first as many of the next row's text.
    """
    rows, _ = neighbours(df, id_col, text_col)
    edited = F.concat(F.expr("left(text_, length(text_) - cast(floor(length(text_) / 2) as int))"),
                      F.expr("left(next_, cast(floor(length(text_) / 2) as int))"))
    rows = rows.withColumn("edited_", edited)
    own = rows.select("g", "rid", "guest", "id_", F.length("text_").cast("long").alias("n_chars"),
                      F.sha2(F.col("edited_").cast("binary"), 256).alias("edited_sha256"))
    texts = rows.select("g", "rid", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text_").alias("t")),
        F.struct(F.lit(1).alias("which"), F.col("edited_").alias("t")))).alias("p")).select("g", "rid", "p.which", "p.t")
    sigs = (signatures(texts, ["g", "rid", "which"], "t", samples).groupBy("g", "rid")
            .agg(F.max(F.when(F.col("which") == 0, F.col("sig_"))).alias("sig"),
                 F.max(F.when(F.col("which") == 1, F.col("sig_"))).alias("edited_sig")))
    order = Window.partitionBy("g").orderBy("rid")
    both = own.join(sigs, ["g", "rid"]).withColumn(
        "next_sig", F.coalesce(F.lead("sig").over(order), F.first("sig").over(order)))
    return both.filter(~F.col("guest")).select(
        F.col("id_").alias(id_col), "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig"), samples).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig"), samples).alias("near_next"))


def op4_weighted_samples(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
