"""OP 2: sharding by proportional stratified interleaving.

Within each source the rows are ranked in a seeded shuffle (by the MD5 of
seed and document id); row ``r`` of ``n`` gets the fraction
``(r + 1/2) / n``.  Sorted by that fraction, every stretch of the order holds the
sources in proportion, so cutting it into equal stretches gives shards that
match the mixture and whose row counts differ by one at most (the law
``rows``).

Both orders are global indexes over narrow rows: a range sort with
per-partition offsets, so a source with any share of the rows is split over
many tasks.  Rows per source come from the first index by map-side
aggregation.

A null source is a source of its own; null ids and texts are rows like any
other (a null text has size 1 and the CRC-32 of nothing); rows equal in all
these columns are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ship
from panelspark.operators.indexing import global_index

ship(__name__)

N_SHARDS = 16
SEED = 20240607
MAX_BROADCAST_SOURCES = 100_000


def interleave(df: DataFrame, strata_col: str = "source", id_col: str = "doc_id", n_shards: int = N_SHARDS,
               seed: int = SEED, tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0
    in each shard); columns of these names are replaced.  Give narrow rows:
    the order is checkpointed."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    keyed = df.select(
        F.struct(*[F.col(c) for c in df.columns if c.lower() not in ("shard", "slot")]).alias("row_"),
        F.col(strata_col).cast("string").alias("s_"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))).alias("k_"),
        F.struct(F.col(id_col), *[F.col(c) for c in tie_cols]).alias("t_"))
    order = [F.col("s_").asc_nulls_first(), F.col("k_").asc(), F.col("t_").asc()]
    ranked = global_index(keyed, order, "i_")
    sizes = ranked.groupBy("s_").agg(F.min("i_").alias("first_"), F.count(F.lit(1)).alias("n_"))
    sizes = sizes.checkpoint()
    small = sizes.count() <= MAX_BROADCAST_SOURCES        # beyond: a shuffled join, skewed keys split by AQE
    sizes = F.broadcast(sizes) if small else sizes
    sizes = sizes.withColumnRenamed("s_", "source_")
    frac = ((F.col("i_") - F.col("first_")) * 2 + 1) / (F.col("n_") * 2).cast("double")
    spread = (ranked.join(sizes, F.col("s_").eqNullSafe(F.col("source_")))
              .select("row_", "s_", "k_", "t_", frac.alias("f_")))
    placed = global_index(spread, [F.col("f_").asc(), F.col("s_").asc_nulls_first(), F.col("k_").asc(), F.col("t_").asc()], "pos_")
    total = sizes.agg(F.coalesce(F.sum("n_"), F.lit(0)).alias("total_"))              # one row
    first = F.expr(f"(shard * total_ + {n_shards - 1}) div {n_shards}")
    return (placed.crossJoin(F.broadcast(total))
            .withColumn("shard", F.expr(f"cast((pos_ * {n_shards}) div total_ as int)"))
            .select("row_.*", "shard", (F.col("pos_") - first).cast("long").alias("slot")))


def op2_interleave(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    out = interleave(rows, tie_cols=("size", "text_crc32"))
    return out.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# CRC-32 byte by byte: its table from the polynomial (a fixed value), then one fold over the text's bytes.
ORACLE = {"op2_interleave": f"""
WITH poly AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(n))),
d AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
base AS (
  SELECT doc_id, source, n + 1 AS size, md5(concat_ws(':', '{SEED}', doc_id)) AS k,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(n), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) AS text_crc32
  FROM d CROSS JOIN poly),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS m FROM base),
placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * r + 1 AS DOUBLE) / CAST(2 * m AS DOUBLE), source NULLS FIRST, k, doc_id) - 1 AS pos,
    count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, (pos * {N_SHARDS}) // total AS s FROM placed)
SELECT doc_id, source, size, text_crc32, 'rows' AS law, CAST(s AS INTEGER) AS shard,
  pos - (s * total + {N_SHARDS - 1}) // {N_SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""}
