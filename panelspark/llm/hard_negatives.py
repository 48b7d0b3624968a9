"""OP 13: hard negatives by Four-Russians scoring of integer vectors.

Components become ``floor(256 * x)``.  A candidate is stored as bit planes: for
each bit of its components in two's complement, one byte per group of eight
dimensions.  For an anchor and a group, a table of 256 entries holds the sum
of the anchor's components over every subset of the eight; a candidate's byte
picks its entry, entries are added over the groups and shifted and added over
the planes (the sign plane is subtracted), which is the full inner product.
Every score is exact and every row is scored; nothing is sampled or cut.

The stated queries, anchors in blocks of ``ANCHORS``, meet all rows in parts
of ``ROWS``, a task per block and part: first the parts of the anchor's own
label, for its positives, then all parts, for the rows of other labels that
score within each positive's window.  A task returns the first few of its
part; a window over these few gives the first of all.  Labels and parts of
any size are cut by the hash of a row, so none is one task.

Rows with a null label, id or vector, or with a null or non-finite component
take no part, nor do those with a component of 65,536 or more (a score might
pass 64 bits).  Vectors are compared with those of their own length; an empty
one scores 0.  Higher scores come first, ties by smaller id; rows that repeat
an id are told apart by the row.  An empty table gives no rows.  Other
columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import release, ship, stage

ship(__name__)

SCALE = 256
LIMIT = 1 << 24            # of a scaled component
ANCHORS = 1_024            # of a block
ROWS = 8_192               # of a part
GROUP = 8                  # dimensions per table
STEP = 512                 # candidates scored at once
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100        # percent of the positive's score


def scaled(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v: scaled components."""
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * SCALE).alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
            .withColumn("v", F.transform(v, lambda x: F.floor(x).cast("int"))))


def planes_needed(largest: int) -> int:
    """Bits of two's complement for components of at most this magnitude."""
    return int(largest).bit_length() + 1


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit ``i`` of a byte is that of dimension ``8 * group + i``."""
    n, dim = values.shape
    groups = max(1, -(-dim // GROUP))
    wide = np.zeros((n, groups * GROUP), np.int64)
    wide[:, :dim] = values
    out = np.empty((n, planes, groups), np.uint8)
    for b in range(planes):
        out[:, b] = np.packbits(((wide >> b) & 1).astype(np.uint8).reshape(n, groups, GROUP), axis=2, bitorder="little")[:, :, 0]
    return out


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): sums of each anchor's components over all subsets of each group."""
    n, dim = anchors.shape
    groups = max(1, -(-dim // GROUP))
    wide = np.zeros((groups * GROUP, n), kind)
    wide[:dim] = anchors.T
    out = np.zeros((groups, 1 << GROUP, n), kind)
    for i in range(GROUP):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + wide[i::GROUP][:, None, :]
    return out


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products by table lookups and shift-adds."""
    groups, _, n = tables.shape
    planes = packed.shape[1]
    total = np.zeros((len(packed), n), tables.dtype)
    line, entry = np.empty_like(total), np.empty_like(total)
    for b in range(planes - 1, -1, -1):
        np.take(tables[0], packed[:, b, 0], axis=0, out=line)
        for g in range(1, groups):
            np.take(tables[g], packed[:, b, g], axis=0, out=entry)
            line += entry
        total <<= 1
        if b == planes - 1:
            total -= line                                       # the sign plane
        else:
            total += line
    return total


def score_type(largest: int, dim: int):
    return np.int32 if max(1, dim) * int(largest) ** 2 < 1 << 30 else np.int64


def first_of_columns(score: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of valid entries that may be among their column's ``k`` highest (ties stay)."""
    full = np.flatnonzero(valid.sum(axis=0) > 4 * k)
    if len(full):
        part = np.where(valid[:, full], score[:, full], np.iinfo(score.dtype).min)
        valid[:, full] &= part >= np.partition(part, len(part) - k, axis=0)[len(part) - k]
    return np.nonzero(valid)


def first_by(keys: list[np.ndarray], score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each key, by higher score, then smaller id."""
    order = np.lexsort((uid, vec_id, -score.astype(np.int64), *keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
    at = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[at < k]


class Part:
    """One task's anchors and candidates, scored a step at a time."""

    def __init__(self, ask: pd.DataFrame, have: pd.DataFrame, planes: int, kind):
        dim = len(ask["v"].iat[0])
        self.tables = subset_sums(np.array(ask["v"].tolist(), np.int64).reshape(len(ask), dim), kind)
        groups = self.tables.shape[0]
        self.packed = np.frombuffer(b"".join(have["planes"]), np.uint8).reshape(len(have), planes, groups)
        self.uid, self.vec_id, self.label = (have[c].to_numpy(np.int64) for c in ("uid", "vec_id", "label"))
        self.ask_uid, self.ask_label = ask["uid"].to_numpy(np.int64), ask["label"].to_numpy(np.int64)

    def steps(self):
        for lo in range(0, len(self.packed), STEP):
            at = slice(lo, lo + STEP)
            yield lo, at, scores(self.tables, self.packed[at])


def positives_task(planes: int, kind, k: int):
    def work(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        names = ["uid", "pos_uid", "positive_id", "positive_score"]
        if not len(ask) or not len(have):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in names})
        part = Part(ask, have, planes, kind)
        best = [np.zeros(0, np.int64)] * 3
        for lo, at, score in part.steps():
            row, col = first_of_columns(score, part.uid[at, None] != part.ask_uid[None, :], k)
            best = [np.concatenate(x) for x in zip(best, (col, row + lo, score[row, col].astype(np.int64)))]
            top = first_by([best[0]], best[2], part.vec_id[best[1]], part.uid[best[1]], k)
            best = [x[top] for x in best]
        col, row, score = best
        release()
        return pd.DataFrame(dict(zip(names, (part.ask_uid[col], part.uid[row], part.vec_id[row], score))))
    return work


def negatives_task(planes: int, kind, k: int, low: int, high: int):
    def work(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        names = ["uid", "place", "neg_uid", "negative_id", "negative_score"]
        if not len(ask) or not len(have):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in names})
        part = Part(ask, have, planes, kind)
        goal = [np.array(x, np.int64) for x in ask["goals"]]    # positives' scores, best first
        deep = max(map(len, goal))
        goals = np.full((len(goal), deep), -1, np.int64)
        for i, g in enumerate(goal):
            goals[i, :len(g)] = g
        best = [np.zeros(0, np.int64)] * 4
        for lo, at, score in part.steps():
            other = part.label[at, None] != part.ask_label[None, :]
            for j in range(deep):
                g = goals[:, j]                                 # below 0: no score lies in the window
                ceiling, floor = high * g // 100, -(-low * g // 100)
                kept = other & (score <= np.where(g < 0, np.iinfo(score.dtype).min, ceiling)) & (score >= np.where(g < 0, 1, floor))
                row, col = first_of_columns(score, kept, k)
                best = [np.concatenate(x) for x in zip(best, (col, np.full(len(col), j), row + lo, score[row, col].astype(np.int64)))]
            top = first_by(best[:2], best[3], part.vec_id[best[2]], part.uid[best[2]], k)
            best = [x[top] for x in best]
        col, place, row, score = best
        release()
        return pd.DataFrame(dict(zip(names, (part.ask_uid[col], place, part.uid[row], part.vec_id[row], score))))
    return work


def _parts(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(float(size))).cast("int")


def blocks_against_rows(asks: DataFrame, rows: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work`` on every block of ``asks`` and every part of ``rows`` that agree on ``keys``."""
    size = (rows.groupBy(*keys).agg(_parts(F.count(F.lit(1)), ROWS).alias("parts"))
            .join(asks.groupBy(*keys).agg(_parts(F.count(F.lit(1)), ANCHORS).alias("blocks")), keys))
    here = (rows.join(size, keys).withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("parts", "blocks"))
    there = (asks.join(size, keys).withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), "blocks").cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks"))
    there = there.select(*[F.col(c).alias(c) for c in there.columns])      # both may come from one table
    by = [*keys, "block", "part"]
    return there.groupBy(*by).cogroup(here.groupBy(*by)).applyInPandas(work, schema)


def mine(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label",
         anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores: for
    each anchor (an id divisible by ``anchor_every``) and each of its first
    ``positives`` rows of its label, the first ``negatives`` rows of other
    labels with ``low`` to ``high`` percent of the positive's score."""
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    plain = scaled(df, id_col, vec_col, F.col(label) if isinstance(label, str) else label)
    most = plain.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("m"), F.max(F.size("v")).alias("d")).first()
    if most["d"] is None:
        return df.sparkSession.createDataFrame([], out)
    planes, kind = planes_needed(most["m"] or 0), score_type(most["m"] or 0, most["d"])

    def pack(batches):
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            v = batch.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            content = [b""] * len(v)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                rows_ = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                for i, raw in zip(at.tolist(), pack_planes(rows_.astype(np.int64), planes)):
                    content[i] = raw.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(uid + np.arange(len(v))), batch.column("vec_id"), batch.column("label"), pa.array(sizes.astype(np.int32)),
                v, pa.array(content, pa.binary())], names=["uid", "vec_id", "label", "dim", "v", "planes"])
            uid += len(v)

    table = stage(plain.mapInArrow(pack, "uid long, vec_id long, label long, dim int, v array<int>, planes binary"), "negatives-rows")
    rows = table.drop("v")
    anchors = table.filter(F.col("vec_id") % anchor_every == 0).drop("planes")
    near = blocks_against_rows(anchors, rows, ["label", "dim"], positives_task(planes, kind, positives),
                               "uid long, pos_uid long, positive_id long, positive_score long")
    best = Window.partitionBy("uid").orderBy(F.desc("positive_score"), "positive_id", "pos_uid")
    near = near.withColumn("place", F.row_number().over(best) - 1).filter(F.col("place") < positives)
    pairs = stage(near.select("uid", "place", "positive_id", "positive_score"), "negatives-positives")
    goals = (pairs.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("g"))    # ``positives`` items
             .select("uid", F.transform("g", lambda x: x["positive_score"]).alias("goals")))
    found = blocks_against_rows(anchors.join(goals, "uid"), rows, ["dim"], negatives_task(planes, kind, negatives, low, high),
                                "uid long, place int, neg_uid long, negative_id long, negative_score long")
    order = Window.partitionBy("uid", "place").orderBy(F.desc("negative_score"), "negative_id", "neg_uid")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return (found.join(pairs, ["uid", "place"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def op13_four_russians(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh is shifted first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=label)


ORACLE = {"op13_four_russians": f"""
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, r.rid, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.rid <> r.rid AND len(a.v) = len(r.v) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (
  SELECT arid, rid AS prid, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY arid, prid ORDER BY score DESC, vec_id, rid) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (arid)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY arid, prid ORDER BY score DESC, vec_id, rid) <= {NEGATIVES}"""}
