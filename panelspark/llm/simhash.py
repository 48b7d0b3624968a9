"""OP 5: SimHash near-duplicates by a self-join of the fingerprints' binary trie.

Fingerprint: A-Z lower-cased, words between ASCII white space, word shingles
(the whole sequence where there are fewer words), XXH64 with seed 42; a bit
is 1 if it is set in more than half of the shingle hashes; no words: zero.

Join: equal fingerprints are one leaf.  The trie's top levels are tables: its
nodes at a depth with their leaf counts, and the node pairs whose prefixes
differ in at most ``max_bits``.  A pair with many leaves is replaced
by its children's pairs a few levels deeper, until every pair is small or
whole; the leaves under a pair then meet in one task, which goes on down
the two subtries together: a pair of nodes carries the bits in which it
differs so far, gives rise to its children's pairs, and is dropped as soon as
the budget is exceeded.  Each task returns a spanning forest of the links
that it found, not all pairs, so a dense group costs one row per leaf.

Components are taken over fingerprints and carried back to the rows, so
copies never become pairs.  Null ids are never a component's id (null only if
all its ids are); null and empty texts have fingerprint zero; repeated rows
keep their rows.  Other columns of the input play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import byte_slices, ship, stage
from panelspark.llm.components import components

ship(__name__)

SHINGLE = 3
MAX_BITS = 2
LEAVES = 8_192             # aimed at per trie node at the first depth
HOT = 65_536               # leaves under a pair beyond which it is split further
STEP = 4                   # levels per split
BROADCAST_PAIRS = 1_000_000
_SLICE = 8 << 20
_CHUNK = 400_000           # node pairs worked on at a time in a task


def shingle_hashes(text: str, size: int) -> list[int]:
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [digest(line, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-size].tolist()]
    return [digest(line[a:b], 42) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes (``counts`` each)."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    # one byte lane per bit: runs are cut so that no lane passes 255
    lut = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).view(np.uint64).ravel()
    cuts = -(-n // 255)
    first = np.repeat(np.cumsum(n) - n, cuts) + 255 * (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    heads = np.cumsum(cuts) - cuts
    fp = np.zeros(len(full), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat(lut[octets[:, k]], first).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(lanes, heads, axis=0)
        bits = (2 * ones > n[:, None]).astype(np.uint64) << np.arange(8, dtype=np.uint64)
        fp |= bits.sum(axis=1, dtype=np.uint64) << np.uint64(8 * k)
    out[full] = fp
    return out


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    src = df.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text_"))
    id_type = src.schema[0].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, _SLICE):
                found, counts = [], []
                for t in part.column(1).to_pylist():
                    h = shingle_hashes(t or "", shingle)
                    counts.append(len(h))
                    found.append(np.array(h, np.uint64))
                fp = majority(np.concatenate(found), np.array(counts, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["id_", "fp"])

    return src.mapInArrow(task, f"id_ {id_type}, fp long")


def trie_links(x: np.ndarray, split: int, bit: int, budget: int):
    """Yields (i, j) index arrays of leaves within ``budget`` bits.

    ``x``: two sorted runs of distinct leaves, ``[0, split)`` and
    ``[split, n)``, each under one node whose next bit is ``bit``; with
    ``split = n`` the node is joined with itself.
    """
    n = len(x)
    ones_before: dict[int, np.ndarray] = {}

    def ones(b, lo, hi):
        if b not in ones_before:
            ones_before[b] = np.concatenate([[0], np.cumsum((x >> np.uint64(b)) & np.uint64(1))]).astype(np.int64)
        return ones_before[b][hi] - ones_before[b][lo]

    same = split == n
    if same:
        start, differ = (0, n, 0, n), 0
    else:
        start = (0, split, split, n)
        differ = int(np.bitwise_count((x[0] ^ x[split]) >> np.uint64(bit + 1))) if bit < 63 else 0
    stack = [(bit, np.array([[*start, differ]], np.int64))]
    while stack:
        b, pairs = stack.pop()
        if len(pairs) > _CHUNK:
            half = len(pairs) // 2
            stack += [(b, pairs[:half]), (b, pairs[half:])]
            continue
        la, ha, lb, hb, d = pairs.T
        na, nb = ha - la, hb - lb
        leaf = (na * nb <= 16) | (b < 0)
        if leaf.any():
            k = np.flatnonzero(leaf)
            size = na[k] * nb[k]
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            i = np.repeat(la[k], size) + at // np.repeat(nb[k], size)
            j = np.repeat(lb[k], size) + at % np.repeat(nb[k], size)
            hit = (np.bitwise_count(x[i] ^ x[j]) <= budget) & ((i < j) | (not same))
            if hit.any():
                yield i[hit], j[hit]
            if leaf.all():
                continue
            la, ha, lb, hb, d = (c[~leaf] for c in (la, ha, lb, hb, d))
        ma, mb = ha - ones(b, la, ha), hb - ones(b, lb, hb)
        own = same & (la == lb) & (ha == hb)
        parts = [np.stack([la, ma, lb, mb, d], 1), np.stack([ma, ha, mb, hb, d], 1), np.stack([la, ma, mb, hb, d + 1], 1),
                 np.stack([ma, ha, lb, mb, d + 1], 1)[~own]]
        kids = np.concatenate(parts)
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)]
        if len(kids):
            stack.append((b - 1, kids))


def unite(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the sets of ``u[k]`` and ``v[k]`` (parents point to smaller indexes)."""
    while len(u):
        for side in (u, v):
            while True:
                up = parent[side]
                if (up == side).all():
                    break
                side[:] = parent[up]
        apart = u != v
        u, v = np.maximum(u, v)[apart], np.minimum(u, v)[apart]
        np.minimum.at(parent, u, v)


def forest(x: np.ndarray, split: int, bit: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links: (leaf, representative) pairs."""
    parent = np.arange(len(x))
    for i, j in trie_links(x, split, bit, budget):
        unite(parent, i.copy(), j.copy())
    while True:
        up = parent[parent]
        if (up == parent).all():
            break
        parent = up
    moved = np.flatnonzero(parent != np.arange(len(x)))
    return x[moved], x[parent[moved]]


def node(depth: int, fp="fp"):
    return F.shiftrightunsigned(F.col(fp), 64 - depth)


def trie_pairs(leaves: DataFrame, depth: int, max_bits: int, hot: int) -> list[tuple[int, DataFrame]]:
    """Node pairs to join, by depth: (a, b) with a <= b, prefixes within the
    budget, at most ``hot`` leaves each unless the trie ends."""
    def nodes(d):
        return leaves.groupBy(node(d).alias("n")).agg(F.count(F.lit(1)).alias("size"))

    flips = [0] + [1 << i for i in range(depth)]
    if max_bits >= 2:
        flips += [(1 << i) | (1 << j) for i in range(depth) for j in range(i)]
    for extra in range(3, max_bits + 1):
        flips = sorted({f ^ (1 << i) for f in flips for i in range(depth)} | set(flips))
        flips = [f for f in flips if f.bit_count() <= extra]
    flips = [f for f in flips if f.bit_count() <= max_bits]
    here = nodes(depth).checkpoint()
    a = here.select(F.col("n").alias("a"), F.col("size").alias("na"))
    b = here.select(F.col("n").alias("b"), F.col("size").alias("nb"))
    pairs = (a.withColumn("f", F.explode(F.array([F.lit(f).cast("long") for f in flips])))
             .withColumn("b", F.col("a").bitwiseXOR(F.col("f"))).filter("a <= b").drop("f").join(b, "b").checkpoint())
    done = []
    while True:
        big = (F.col("na") + F.col("nb") > hot) if depth + STEP <= 60 else F.lit(False)
        done.append((depth, pairs.filter(~big).select("a", "b")))
        big_pairs = pairs.filter(big)
        if big_pairs.isEmpty():
            return done
        depth += STEP
        kids = nodes(depth).withColumn("up", F.shiftrightunsigned("n", STEP)).checkpoint()
        ka = kids.select(F.col("up").alias("a"), F.col("n").alias("ca"), F.col("size").alias("na"))
        kb = kids.select(F.col("up").alias("b"), F.col("n").alias("cb"), F.col("size").alias("nb"))
        pairs = (big_pairs.select("a", "b").join(ka, "a").join(kb, "b")
                 .filter((F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= max_bits)
                         & ((F.col("a") < F.col("b")) | (F.col("ca") <= F.col("cb"))))
                 .select(F.col("ca").alias("a"), F.col("cb").alias("b"), "na", "nb").checkpoint())


def trie_self_join(leaves: DataFrame, max_bits: int = MAX_BITS, per_node: int = LEAVES, hot: int = HOT) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of ``leaves.fp``
    (distinct 64-bit values) that differ in at most ``max_bits`` bits."""
    spark = leaves.sparkSession
    total = leaves.count()
    depth = max(1, min(24, math.ceil(math.log2(max(1, total) / per_node)))) if total > per_node else 1
    out = None
    for d, pairs in trie_pairs(leaves, depth, max_bits, hot):
        if pairs.isEmpty():
            continue
        many = pairs.count() > BROADCAST_PAIRS
        sides = (pairs.select(F.col("a").alias("n"), "a", "b", F.lit(0).alias("side"))
                 .unionByName(pairs.filter("a <> b").select(F.col("b").alias("n"), "a", "b", F.lit(1).alias("side"))))
        rows = leaves.select("fp", node(d).alias("n")).join(sides if many else F.broadcast(sides), "n").drop("n")
        bit = 63 - d

        def links(pdf: pd.DataFrame) -> pd.DataFrame:
            x = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            side = pdf["side"].to_numpy()
            left, right = np.sort(x[side == 0]), np.sort(x[side == 1])
            own = pdf["a"].iat[0] == pdf["b"].iat[0]
            if not own and (not len(left) or not len(right)):
                return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
            u, v = forest(np.concatenate([left, right]), len(left), bit, max_bits)
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

        found = rows.groupBy("a", "b").applyInPandas(links, "u long, v long")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "u long, v long") if out is None else out


def component_of(fps: DataFrame, max_bits: int, per_node: int, hot: int) -> DataFrame:
    """(fp, low_, root): every distinct fingerprint, its smallest id and the
    fingerprint that names its component."""
    leaves = stage(fps.groupBy("fp").agg(F.min("id_").alias("low_")), "leaves")
    roots = components(trie_self_join(leaves, max_bits, per_node, hot))
    return (leaves.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("root", F.coalesce("root", "fp")))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, per_node: int = LEAVES, hot: int = HOT) -> DataFrame:
    """One row per row of ``df``: the id column, ``fingerprint`` (16 hex
    digits), ``fp`` (the same as a long), ``component_id`` (smallest id)."""
    fps = stage(fingerprints(df, id_col, text_col, shingle), "simhash")
    named = component_of(fps, max_bits, per_node, hot)
    lowest = named.groupBy("root").agg(F.min("low_").alias("component_id"))
    of_fp = named.join(lowest, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(of_fp, "fp").select(F.col("id_").alias(id_col), hexed.alias("fingerprint"), "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, per_node: int = LEAVES, hot: int = HOT) -> DataFrame:
    """The rows of ``df``, one of each component: that of the smallest id (null
    last; of equal ids that of the smaller text hash; of equal rows any one)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = df.select(
        F.struct(*[F.col(c) for c in df.columns]).alias("row_"), text.alias("text_"),
        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"),
                 F.xxhash64(F.lit(1), text).alias("k2")).alias("id_"))
    fps = stage(fingerprints(keyed, "id_", "text_", shingle), "simhash")
    named = component_of(fps, max_bits, per_node, hot)
    first = named.groupBy("root").agg(F.min("low_").alias("w")).select(
        F.col("w.k1").alias("k1"), F.col("w.k2").alias("k2"), F.coalesce(F.col("w.id").cast("string"), F.lit("")).alias("key"))
    rows = keyed.select("row_", F.col("id_.k1").alias("k1"), F.col("id_.k2").alias("k2"),
                        F.coalesce(F.col("id_.id").cast("string"), F.lit("")).alias("key"))
    nth = Window.partitionBy("k1", "k2", "key").orderBy("key")
    return (rows.join(first, ["k1", "k2", "key"]).withColumn("nth", F.row_number().over(nth)).filter("nth = 1")
            .select(*[F.col("row_").getField(c).alias(c) for c in df.columns]))


def op5_simhash_trie(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select("doc_id", "fingerprint", "component_id")
