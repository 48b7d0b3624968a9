"""OP 12: resampling towards a target distribution by hashed n-gram importance.

A document's features are its runs of 1 to ``order`` consecutive words (one
space between them, repeats counted); a feature's bucket is its CRC-32 modulo
``buckets``.  The gain of a bucket compares its share of the target's features
with its share of the documents'; a document weighs the sum of the gains of
its features, a seeded Gumbel draw is added, and the highest ``percent`` of
the documents with ``min_words`` words are drawn.

Both passes over the texts intern the n-grams of a slice in an open-addressed
NumPy table: the XXH64 of a run of bytes picks its first slot, all pending
occurrences probe at once, and an occurrence settles where key and bytes equal
those of the slot's owner.  A slot holds the bucket and the count of its
n-gram, so the first pass adds counts by bucket and the second gathers gains
by each occurrence's slot.  A task keeps one slice and one bucket vector.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Null
and empty texts hold no words: weight 0, never drawn; texts of any length are
read whole (a single one may exceed the slice).  Ties go to the smaller id, null
ids last (their seed text is ``<seed>:``), then by features and weight; repeated
rows are drawn separately.  Empty tables give no rows; an empty target has
T = 0.  Kept columns that are named like a result come back with ``_in``.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import byte_slices, ragged, release, ship, stage
from panelspark.operators.indexing import global_index

ship(__name__)

ORDER = 1
BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
_SLICE = 4 << 20
RESULT = ("n_features", "weight", "score", "rank")

# fixed values: the primes of XXH64
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[:128] = False
_WORD[48:58] = True
_WORD[97:123] = True


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_rows(rows: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each row of a matrix of bytes with fewer than 32 columns."""
    n, width = rows.shape
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(seed) + P5 + np.uint64(width), np.uint64)
        at = 0
        while at + 8 <= width:
            lane = np.ascontiguousarray(rows[:, at:at + 8]).view("<u8").ravel()
            h = _rotl(h ^ (_rotl(lane * P2, 31) * P1), 27) * P1 + P4
            at += 8
        if at + 4 <= width:
            lane = np.ascontiguousarray(rows[:, at:at + 4]).view("<u4").ravel().astype(np.uint64)
            h = _rotl(h ^ (lane * P1), 23) * P2 + P3
            at += 4
        for k in range(at, width):
            h = _rotl(h ^ (rows[:, k].astype(np.uint64) * P5), 11) * P1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def xxh64_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of each run of bytes; long ones one by one."""
    import xxhash
    out = np.empty(len(start), np.uint64)
    order = np.argsort(size, kind="stable")
    sizes, first = np.unique(size[order], return_index=True)
    for width, lo, hi in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        at = order[lo:hi]
        if width < 32:
            out[at] = xxh64_rows(buf[start[at][:, None] + np.arange(width)])
        else:
            out[at] = [xxhash.xxh64_intdigest(buf[a:a + width].tobytes()) for a in start[at].tolist()]
    return out


def equal_spans(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` and from ``b`` are equal, by pairs."""
    out = np.ones(len(a), bool)
    apart = np.flatnonzero(a != b)
    if len(apart):
        n = size[apart]
        differ = buf[ragged(a[apart], n)] != buf[ragged(b[apart], n)]
        ends = np.cumsum(n)
        total = np.concatenate([[0], np.cumsum(differ)])
        out[apart] = total[ends] == total[ends - n]
    return out


class GramTable:
    """Open-addressed table of the n-grams of one slice: ``slot`` of each
    occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray, buckets: int, hashes=xxh64_spans):
        keys = hashes(buf, start, size)
        capacity = 1 << 14
        slot = None
        while slot is None:
            capacity <<= 2
            slot = self._settle(buf, start, size, keys, capacity)
        taken = np.flatnonzero(self._owner >= 0)
        dense = np.zeros(capacity, np.int64)
        dense[taken] = np.arange(len(taken))
        self.slot = dense[slot]
        owner = self._owner[taken]
        raw = buf.tobytes()
        self.bucket = np.fromiter((zlib.crc32(raw[a:b]) % buckets for a, b in zip(start[owner].tolist(), (start + size)[owner].tolist())),
                                  np.int64, len(owner))
        self.count = np.bincount(self.slot, minlength=len(owner))

    def _settle(self, buf, start, size, keys, capacity):
        mask = np.uint64(capacity - 1)
        owner = np.full(capacity, -1, np.int64)
        slot = np.empty(len(start), np.int64)
        pending, at, held = np.arange(len(start)), (keys & mask).astype(np.int64), 0
        while len(pending):
            free = owner[at] < 0
            if free.any():
                owner[at[free]] = pending[free]                # one of them stays as the owner
                held = int((owner >= 0).sum())
                if 2 * held > capacity:
                    return None
            own = owner[at]
            same = (keys[own] == keys[pending]) & (size[own] == size[pending])
            near = np.flatnonzero(same)
            same[near] = equal_spans(buf, start[own[near]], start[pending[near]], size[pending[near]])
            slot[pending[same]] = at[same]
            pending, at = pending[~same], (at[~same] + 1) & (capacity - 1)
        self._owner = owner
        return slot


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' lower-cased bytes end to end, and each word's document, start and length."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    buf = _LOWER[np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = _WORD[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True                                        # a text begins or ends
    cut[1:][~inside] = True
    cut[:-1][~inside] = True
    start = np.flatnonzero(inside & cut[:-1])
    end = np.flatnonzero(inside & cut[1:]) + 1
    return buf, np.searchsorted(offsets, start, side="right") - 1, start, end - start


def grams(column: pa.Array, order: int):
    """``(bytes, document, start, length)`` of all n-grams of the texts, and words per text."""
    buf, doc, start, size = word_spans(column)
    words = np.bincount(doc, minlength=len(column))
    if order == 1:
        return buf, doc, start, size, words
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)         # words with one space behind each
    place = np.cumsum(size + 1) - size - 1
    joined[ragged(place, size)] = buf[ragged(start, size)]
    docs, starts, sizes = [doc], [place], [size]
    for n in range(2, order + 1):
        if len(doc) < n:
            break
        first = np.flatnonzero(doc[:-(n - 1)] == doc[n - 1:])
        docs.append(doc[first])
        starts.append(place[first])
        sizes.append(place[first + n - 1] + size[first + n - 1] - place[first])
    return joined, np.concatenate(docs), np.concatenate(starts), np.concatenate(sizes), words


def bucket_counts(df: DataFrame, text_col: str, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts; a task sends each bucket once."""
    def task(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, 0, _SLICE):
                buf, _, start, size, _ = grams(part.column(0), order)
                if len(start):
                    table = GramTable(buf, start, size, buckets)
                    np.add.at(total, table.bucket, table.count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])
        release()

    return (df.select(F.col(text_col).cast("string").alias("text_")).mapInArrow(task, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(documents: DataFrame, target: DataFrame, text_col: str, target_col: str,
          order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket: floor of 1000 times the log ratio of smoothed shares."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in bucket_counts(documents, text_col, order, buckets).collect():      # ``buckets`` rows at most
        s[r["bucket"]] = r["n"]
    for r in bucket_counts(target, target_col, order, buckets).collect():
        t[r["bucket"]] = r["n"]
    all_s, all_t = float(int(s.sum()) + buckets), float(int(t.sum()) + buckets)
    return np.array([math.floor(1000 * math.log(float(b + 1) * all_s / (float(a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weights(df: DataFrame, gain: np.ndarray, text_col: str, keep: list[str], order: int = ORDER) -> DataFrame:
    """``row_`` (the kept columns), ``n_words``, ``n_features`` and ``weight`` of every row."""
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row_"), F.col(text_col).cast("string").alias("text_"))
    shared = df.sparkSession.sparkContext.broadcast(gain)                       # ``buckets`` numbers
    buckets = len(gain)

    def task(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, _SLICE):
                buf, doc, start, size, words = grams(part.column(1), order)
                weight = np.zeros(part.num_rows, np.int64)
                if len(start):
                    table = GramTable(buf, start, size, buckets)
                    np.add.at(weight, doc, shared.value[table.bucket][table.slot])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(words.astype(np.int64)), pa.array(np.bincount(doc, minlength=part.num_rows).astype(np.int64)),
                    pa.array(weight)], names=["row_", "n_words", "n_features", "weight"])
        release()

    return src.mapInArrow(task, f"row_ {src.schema['row_'].dataType.simpleString()}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int) -> Column:
    """1000 times a standard Gumbel draw, rounded down, from the seeded hash of an id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             keep: list[str] | None = None, order: int = ORDER, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` (all, if not given) of every document with
    ``n_features``, ``weight``, ``score`` and ``rank`` (null unless drawn)."""
    keep = documents.columns if keep is None else keep
    own = list(dict.fromkeys([*keep, id_col]))
    gain = gains(documents, target, text_col, target_col, order, buckets)
    scored = stage(weights(documents, gain, text_col, own, order)
                   .withColumn("score", F.col("weight") + gumbel(F.col("row_").getField(id_col), seed)), "importance")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    placed = global_index(scored.filter(able), [F.desc("score"), F.col("row_").getField(id_col).asc_nulls_last(), "n_features", "weight"], "at_")
    ranked = placed.withColumn("rank", F.when(F.col("at_") < drawn, F.col("at_") + 1)).drop("at_")
    out = ranked.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select(*[F.col("row_").getField(c).alias(c + "_in" if c in RESULT else c) for c in keep], *RESULT)


def op12_importance(spark, sf_dir: str) -> DataFrame:
    """Every document's weight towards ``benchmark`` and its place in the draw."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# CRC-32 byte by byte, per distinct word: its table from the polynomial (a fixed value), then one fold over the bytes.
ORACLE = {"op12_importance": f"""
WITH poly AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(n))),
d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_WORDS}') AS w FROM documents),
w AS (SELECT rid, unnest(w) AS g FROM d),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_WORDS}')) AS g FROM benchmark),
kinds AS (SELECT g, hex(encode(g)) AS x, strlen(g) AS n FROM (SELECT g FROM w UNION SELECT g FROM b)),
bucket AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(n), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % {BUCKETS} AS k
  FROM kinds CROSS JOIN poly),
s AS (SELECT k, count(*) AS n FROM w JOIN bucket USING (g) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (g) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM w) + {BUCKETS} AS DOUBLE))
      / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM b) + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (k)),
sums AS (SELECT rid, sum(gain) AS weight FROM w JOIN bucket USING (g) JOIN gain USING (k) GROUP BY rid),
h AS (SELECT rid, doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(CAST('0x' || substr(sha256(concat('{SEED}:', doc_id)), 1, 8) AS BIGINT) AS DOUBLE) AS h
  FROM d LEFT JOIN sums USING (rid)),
scored AS (SELECT rid, doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h),
placed AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= {PERCENT} * n // 100 THEN r END AS rank
FROM scored LEFT JOIN placed USING (rid)"""}
