"""OP 11: near-duplicate vectors by range search on a robust-pruned flat graph.

Two vectors are linked if their cosine is ``cosine`` or more.

1. Equal vectors become one kind; dense groups become balls: around a medoid
   with many neighbours, all vectors within half the linking angle, which are
   therefore all linked with each other.  A ball is one node of the graph, so a
   group of near copies of any size is neither paired nor gathered.
2. ``TREES`` seeded trees of spherical k-means (fitted in tasks, on a bounded
   sample of each node of the tree) cut the nodes into shards of up to
   ``SHARD_MAX`` rows; a node is in one shard of each tree, so the shards of
   different trees overlap.
3. Within a shard each node's nearest candidates are robust-pruned (a candidate
   goes if a kept one is ``ALPHA`` times nearer to it than the node); the
   adjacency lists of all trees are united.
4. Every node searches its shard of the first tree greedily from the medoid
   with a beam over the united lists and then expands through all that is in
   range; across shards the expansion goes on as joins, a round per step,
   until no round finds a new pair.  The range of a pair is the linking angle
   and both radii.
5. Pairs found are verified on the original vectors in double precision.  A
   pair of balls counts by its sizes where radii prove that all members are
   linked; in other cases members are compared in blocks that return counts.
6. A hash sample of ``AUDIT`` vectors is compared with all others by brute
   force; while less than ``TARGET`` of their links were found, the number of
   trees is doubled, up to ``MOST_TREES`` (then a warning states the recall).

Components come from star contraction over the links of nodes.  Vectors that
are null, empty, zero or hold null or non-finite components link with nothing,
nor do those whose length isn't the most frequent one (the longer, if even).
Rows are told apart by the row, not the id, so rows that repeat an id link with
each other; null ids count as links but name no component unless all are null.
An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.ann import centres, matrix, unit
from panelspark.llm.common import ragged, release, ship, stage
from panelspark.llm.components import components

ship(__name__)

COSINE = 0.9
SHARD_ROWS = 2_048         # aimed at per shard
SHARD_MAX = 4_096
FAN = 64                   # children of a tree's node at most
FIT_ROWS = 4_096           # sample of a tree's node
TREES, MOST_TREES = 3, 12
BALL_SAMPLE = 16           # sampled neighbours that make a medoid
BALL_ROWS = 8              # members that make one within a shard
DEGREE = 16
CANDIDATES = 48
ALPHA = 1.2
BEAM = 16
AUDIT = 1_000
TARGET = 0.95
BLOCK = 512
MEMBERS = 4_096            # of a ball per task
TREE_BITS = 15             # low bits of a shard's number: its tree
SLACK = 1e-3               # radians; angles are taken in single precision, links in double


def angles(dots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(dots, -1.0, 1.0))


def units(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return unit(matrix(column, dim).astype(np.float64))


def medoids(u: np.ndarray, half: float, least: int) -> np.ndarray:
    """Rows that cover at least ``least`` others within ``half``, densest first, none within it of another."""
    near = math.cos(half)
    degree = np.concatenate([(u[lo:lo + BLOCK] @ u.T >= near).sum(axis=1) for lo in range(0, len(u), BLOCK)]) if len(u) else np.zeros(0, int)
    free = np.ones(len(u), bool)
    out = []
    for i in np.argsort(-degree, kind="stable"):
        if degree[i] <= least:
            break
        if free[i]:
            mine = (u @ u[i] >= near) & free
            if mine.sum() > least:
                out.append(i)
                free &= ~mine
    return np.array(out, np.int64)


def tree_level(state: DataFrame, dim: int, half: float | None) -> DataFrame | None:
    """The next level of shards that are too large: ``uid``, ``x``, ``home`` and, if ``half``
    is given, ``medoid`` and ``angle`` of rows that fall into a ball (null for others)."""
    big = state.groupBy("home").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARD_MAX)
    big = stage(big, "graph-sizes")
    if big.isEmpty():
        return None
    rows = state.join(big, "home")
    share = F.pmod(F.xxhash64("uid", "home"), F.lit(1 << 30)) < F.lit(float(FIT_ROWS << 30)) / F.col("n")
    xt = state.schema["x"].dataType.simpleString()

    def fit(table: pa.Table) -> pa.Table:
        home, n = table.column("home")[0].as_py(), table.column("n")[0].as_py()
        u = units(table.column("x"), dim)
        c = centres(u, min(len(u), FAN, max(2, -(-n // SHARD_ROWS))))
        lead = medoids(u, half, BALL_SAMPLE) if half is not None else np.zeros(0, np.int64)
        both = np.concatenate([c, u[lead]]).astype(np.float32)
        who = pa.concat_arrays([pa.nulls(len(c), pa.int64()), table.column("uid").combine_chunks().take(pa.array(lead))])
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(both) + 1, dtype=np.int32) * dim), pa.array(both.ravel()))
        return pa.table({"home": pa.array([home] * len(both), pa.int64()), "at": pa.array(np.arange(len(both), dtype=np.int32)), "who": who, "c": flat})

    # the sample is near ``FIT_ROWS`` rows a node of the tree, whatever its size
    fits = stage(rows.filter(share).select("home", "n", "uid", "x").groupBy("home").applyInArrow(
        fit, "home long, at int, who long, c array<float>"), "graph-fits")
    parts = F.ceil(F.col("n") / F.lit(float(MEMBERS))).cast("int")
    here = rows.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(1)), parts).cast("int")).select("home", "part", "uid", "x")
    there = (fits.join(big, "home").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("home", "part", "at", "who", "c"))
    there = there.select(*[F.col(c).alias(c) for c in there.columns])

    def assign(table: pa.Table, fitted: pa.Table) -> pa.Table:
        import xxhash
        n = table.num_rows
        if not n or not fitted.num_rows:
            return pa.table({"uid": table.column("uid"), "x": table.column("x"), "home": table.column("home"),
                             "medoid": pa.nulls(n, pa.int64()), "angle": pa.nulls(n, pa.float64())})
        u = units(table.column("x"), dim)
        fitted = fitted.sort_by("at")
        c = matrix(fitted.column("c").combine_chunks(), dim)
        lead = fitted.column("who").is_valid().to_numpy()
        home = table.column("home")[0].as_py()
        names = np.array([xxhash.xxh64_intdigest(f"{home}:{k}") >> 1 & ~TREE_BITS | home & TREE_BITS for k in range(int((~lead).sum()))], np.int64)
        child = names[(u @ c[~lead].T).argmax(axis=1)]
        medoid, angle = np.zeros(n, np.int64), np.full(n, np.inf)
        if lead.any():
            dots = u @ c[lead].T
            best = dots.argmax(axis=1)
            angle = angles(dots[np.arange(n), best])
            medoid = fitted.column("who").drop_null().to_numpy()[best]
            angle[medoid == table.column("uid").to_numpy()] = 0.0
        out = angle > (half if half is not None else -1)
        return pa.table({"uid": table.column("uid"), "x": table.column("x"), "home": pa.array(child),
                         "medoid": pa.array(medoid, mask=out), "angle": pa.array(angle, mask=out)})

    return stage(here.groupBy("home", "part").cogroup(there.groupBy("home", "part")).applyInArrow(
        assign, f"uid long, x {xt}, home long, medoid long, angle double").unionByName(
        state.join(big, "home", "left_anti").select("uid", "x", "home").withColumn("medoid", F.lit(None).cast("long")).withColumn("angle", F.lit(None).cast("double"))),
        "graph-level")


def grown(state: DataFrame, dim: int, half: float | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves (``uid``, ``x``, ``home``) of the trees and the balls (``uid``, ``medoid``, ``angle``) met on the way."""
    balls, before = [], None
    while (level := tree_level(state, dim, half)) is not None:
        if half is not None:
            balls.append(level.filter("medoid is not null").select("uid", "medoid", "angle"))
            level = level.filter("medoid is null")
        state = level.select("uid", "x", "home")
        largest = state.groupBy("home").count().agg(F.max("count")).first()[0] or 0
        if before is not None and largest > 0.9 * before:      # rows that no centre parts: by their hash
            sizes = state.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(SHARD_ROWS))).alias("p"))
            state = stage(state.join(sizes, "home").withColumn("home", F.when(F.col("p") > 2, F.xxhash64("home", F.pmod(F.xxhash64("uid"), "p"))
                                                               .bitwiseAND(F.lit(~TREE_BITS)).bitwiseOR(F.col("home").bitwiseAND(F.lit(TREE_BITS)))).otherwise(F.col("home"))).select("uid", "x", "home"), "graph-level")
        before = largest
    return state, balls


def collapsed(kinds: DataFrame, dim: int, half: float) -> DataFrame:
    """(uid, medoid, angle) of the kinds that are in a ball, its medoid among them."""
    leaves, balls = grown(kinds.select("uid", "x", F.lit(0).cast("long").alias("home")), dim, half)

    def cover(table: pa.Table) -> pa.Table:
        u, uid = units(table.column("x"), dim), table.column("uid").to_numpy()
        lead = medoids(u, half, BALL_ROWS)
        if not len(lead):
            return pa.table({"uid": pa.array([], pa.int64()), "medoid": pa.array([], pa.int64()), "angle": pa.array([], pa.float64())})
        dots = u @ u[lead].T
        best = dots.argmax(axis=1)
        best[lead] = np.arange(len(lead))
        angle = angles(dots[np.arange(len(u)), best])
        angle[lead] = 0.0
        some = angle <= half
        return pa.table({"uid": pa.array(uid[some]), "medoid": pa.array(uid[lead][best[some]]), "angle": pa.array(angle[some])})

    found = leaves.groupBy("home").applyInArrow(cover, "uid long, medoid long, angle double")
    for b in balls:
        found = found.unionByName(b)
    return stage(found, "graph-balls")


def robust_prune(u: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Edges (from, to, cosine) between rows, all rows of a block pruned side by side."""
    n = len(u)
    c = min(CANDIDATES, n - 1)
    out = []
    for lo in range(0, n if c > 0 else 0, BLOCK):
        rows = np.arange(lo, min(lo + BLOCK, n))
        dots = u[rows] @ u.T
        dots[np.arange(len(rows)), rows] = -2.0
        cand = np.argpartition(-dots, c - 1, axis=1)[:, :c]
        near = np.take_along_axis(dots, cand, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        among = u[cand] @ u[cand].transpose(0, 2, 1)
        alive = np.ones(cand.shape, bool)
        each = np.arange(len(rows))
        for _ in range(DEGREE):
            some = each[alive.any(axis=1)]
            if not len(some):
                break
            pick = alive[some].argmax(axis=1)
            out.append((rows[some], cand[some, pick], near[some, pick]))
            # squared distances of unit vectors are twice one minus the cosine
            alive[some] &= ALPHA ** 2 * (1 - among[some, pick]) > 1 - near[some]
            alive[some, pick] = False
    return out


ADJACENT = "array<struct<to:bigint,a:float,r:float>>"


def shard_graphs(leaves: DataFrame, nodes: DataFrame, dim: int) -> DataFrame:
    """(uid, r, adj): the united adjacency lists, with angles and radii of the neighbours."""
    def build(table: pa.Table) -> pa.Table:
        uid, r = table.column("uid").to_numpy(), table.column("r").to_numpy().astype(np.float32)
        edges = robust_prune(units(table.column("x"), dim).astype(np.float32))
        i, j, dot = (np.concatenate(x) for x in zip(*edges)) if edges else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        order = np.argsort(i, kind="stable")
        i, j, dot = i[order], j[order], dot[order]
        bounds = pa.array(np.searchsorted(i, np.arange(len(uid) + 1)).astype(np.int32))
        items = pa.StructArray.from_arrays([pa.array(uid[j]), pa.array(angles(dot).astype(np.float32)), pa.array(r[j])], ["to", "a", "r"])
        return pa.table({"uid": pa.array(uid), "r": pa.array(r), "adj": pa.ListArray.from_arrays(bounds, items)})

    lists = leaves.select("uid", "home").join(nodes.select("uid", "x", "r"), "uid").groupBy("home").applyInArrow(build, f"uid long, r float, adj {ADJACENT}")
    return stage(lists.groupBy("uid").agg(F.first("r").alias("r"), F.array_distinct(F.flatten(F.collect_list("adj"))).alias("adj")), "graph-lists")


def greedy(u: np.ndarray, adj: np.ndarray, start: int, beam: int) -> np.ndarray:
    """(queries, rows) visited by every row's best-first search for itself, all searches in lockstep."""
    n = len(u)
    seen = np.zeros((n, n), bool)
    ids, far = np.full((n, beam), -1, np.int64), np.full((n, beam), np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    ids[:, 0], far[:, 0], seen[:, start] = start, 1 - u @ u[start], True
    going = np.arange(n)
    while len(going):
        fresh = (ids[going] >= 0) & ~done[going]
        going, fresh = going[fresh.any(axis=1)], fresh[fresh.any(axis=1)]
        if not len(going):
            break
        place = fresh.argmax(axis=1)                            # a beam is sorted: its nearest unexpanded row
        done[going, place] = True
        nb = adj[ids[going, place]]
        new = (nb >= 0) & ~seen[going[:, None], nb]
        q, at = np.nonzero(new)
        x = nb[q, at]
        seen[going[q], x] = True
        d = np.full(nb.shape, np.inf, np.float32)
        for lo in range(0, len(q), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            d[q[s], at[s]] = 1 - (u[going[q[s]]] * u[x[s]]).sum(axis=1)
        all_d = np.concatenate([far[going], d], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        far[going] = np.take_along_axis(all_d, keep, axis=1)
        ids[going] = np.take_along_axis(np.concatenate([ids[going], np.where(np.isinf(d), -1, nb)], axis=1), keep, axis=1)
        done[going] = np.take_along_axis(np.concatenate([done[going], np.zeros(nb.shape, bool)], axis=1), keep, axis=1)
    return seen


def range_search(u: np.ndarray, r: np.ndarray, adj: np.ndarray, theta: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, angle) of pairs in range: greedy from the medoid, then through all rows in range."""
    def within(q, x):
        a = np.concatenate([np.zeros(0, np.float32), *(angles((u[q[lo:lo + 65536]] * u[x[lo:lo + 65536]]).sum(axis=1)) for lo in range(0, len(q), 65536))])
        ok = (a <= theta + r[q] + r[x] + SLACK) & (q != x)
        return q[ok], x[ok], a[ok]

    start = int((u @ u.mean(axis=0)).argmax())
    seen = greedy(u, adj, start, BEAM)
    itself = np.arange(len(u))
    seen[itself, itself] = True
    q, x = np.nonzero(seen)
    front = within(q, x)
    found = [front]
    front = (np.concatenate([itself, front[0]]), np.concatenate([itself, front[1]]))
    while len(front[0]):
        nb = adj[front[1]]
        q, x = np.broadcast_to(front[0][:, None], nb.shape)[nb >= 0], nb[nb >= 0]
        new = ~seen[q, x]
        pair = np.unique(q[new] * len(u) + x[new])
        q, x = pair // len(u), pair % len(u)
        seen[q, x] = True
        front = within(q, x)
        found.append(front)
    return tuple(np.concatenate(c) for c in zip(*found))


PAIR = "a long, b long, angle float, ra float, rb float"


def pairs_in_range(nodes: DataFrame, leaves: DataFrame, lists: DataFrame, dim: int, theta: float) -> DataFrame:
    """Pairs of nodes (a < b) found in range, each once."""
    def search(table: pa.Table) -> pa.Table:
        uid, r = table.column("uid").to_numpy(), table.column("r").to_numpy().astype(np.float32)
        u = units(table.column("x"), dim).astype(np.float32)
        order = np.argsort(uid)
        adj_col = table.column("adj").combine_chunks()
        to = adj_col.flatten().field("to").to_numpy()
        sizes = np.diff(adj_col.offsets.to_numpy())
        at = np.searchsorted(uid[order], to)
        local = order[np.minimum(at, len(uid) - 1)]
        local = np.where(uid[local] == to, local, -1)           # neighbours of other shards are met by joins
        adj = np.full((len(uid), max(1, int(sizes.max(initial=0)))), -1, np.int64)
        row = np.repeat(np.arange(len(uid)), sizes)
        adj[row, ragged(np.zeros(len(sizes), np.int64), sizes)] = local
        q, x, a = range_search(u, r, adj, theta)
        low = uid[q] < uid[x]
        lo, hi = np.where(low, q, x), np.where(low, x, q)
        release()
        return pa.table({"a": pa.array(uid[lo]), "b": pa.array(uid[hi]), "angle": pa.array(a.astype(np.float32)), "ra": pa.array(r[lo]), "rb": pa.array(r[hi])})

    members = (leaves.select("uid", "home").join(nodes.select("uid", "x", "r"), "uid").join(lists.select("uid", "adj"), "uid"))
    searched = members.groupBy("home").applyInArrow(search, PAIR)
    reach = F.lit(theta + SLACK)
    edges = lists.select("uid", "r", F.explode(F.filter("adj", lambda e: e["a"] <= reach + F.col("r") + e["r"])).alias("e"))

    def ordered(df, q, x, rq, rx):
        low = F.col(q) < F.col(x)
        return df.select(F.when(low, F.col(q)).otherwise(F.col(x)).alias("a"), F.when(low, F.col(x)).otherwise(F.col(q)).alias("b"),
                         *(["angle"] if "angle" in df.columns else []), F.when(low, F.col(rq)).otherwise(F.col(rx)).alias("ra"),
                         F.when(low, F.col(rx)).otherwise(F.col(rq)).alias("rb"))

    direct = ordered(edges.select("uid", "r", F.col("e.to").alias("to"), F.col("e.a").alias("angle"), F.col("e.r").alias("rx")), "uid", "to", "r", "rx")

    def once(df):
        return df.groupBy("a", "b").agg(F.min("angle").alias("angle"), F.first("ra").alias("ra"), F.first("rb").alias("rb"))

    known = front = stage(once(searched.unionByName(direct)), "graph-pairs")

    def measure(batches):
        for batch in batches:
            a = angles((units(batch.column("xa"), dim) * units(batch.column("xb"), dim)).sum(axis=1)) if batch.num_rows else np.zeros(0)
            r = batch.column("ra").to_numpy(), batch.column("rb").to_numpy()
            ok = pa.array(a <= theta + r[0] + r[1] + SLACK)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(a.astype(np.float32)), batch.column("ra"), batch.column("rb")],
                                             names=["a", "b", "angle", "ra", "rb"]).filter(ok)

    while not front.isEmpty():
        both = (front.select(F.col("a").alias("q"), F.col("b").alias("uid"), F.col("angle").alias("way"), F.col("ra").alias("rq"))
                .unionByName(front.select(F.col("b").alias("q"), F.col("a").alias("uid"), F.col("angle").alias("way"), F.col("rb").alias("rq"))))
        # a neighbour of ``x`` can be in range of ``q`` only if its angle to ``x`` is at most the way to ``x`` more
        ahead = both.join(lists.select("uid", "adj"), "uid").select("q", "rq", F.explode(F.filter("adj", lambda e: (e["to"] != F.col("q")) & (
            e["a"] - F.col("way") <= reach + SLACK + F.col("rq") + e["r"]))).alias("e"))
        ahead = ordered(ahead.select("q", "rq", F.col("e.to").alias("to"), F.col("e.r").alias("rx")), "q", "to", "rq", "rx").dropDuplicates(["a", "b"])
        ahead = ahead.join(known.select("a", "b"), ["a", "b"], "left_anti")
        x = nodes.select("uid", "x")
        ahead = (ahead.join(x.select(F.col("uid").alias("a"), F.col("x").alias("xa")), "a").join(x.select(F.col("uid").alias("b"), F.col("x").alias("xb")), "b")
                 .select("a", "b", "ra", "rb", "xa", "xb"))
        front = stage(ahead.mapInArrow(measure, PAIR), "graph-pairs")
        known = known.unionByName(front)
    return known


def linked(known: DataFrame, nodes: DataFrame, members: DataFrame, dim: int, cosine: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links between nodes (a, b), and what they add to the link numbers of whole nodes (uid, more) and of members."""
    theta = math.acos(cosine)
    info = nodes.select("uid", "x", "n", "kinds")
    pairs = (known.join(info.select(F.col("uid").alias("a"), F.col("x").alias("xa"), F.col("n").alias("na"), F.col("kinds").alias("ka")), "a")
             .join(info.select(F.col("uid").alias("b"), F.col("x").alias("xb"), F.col("n").alias("nb"), F.col("kinds").alias("kb")), "b"))

    def verify(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dot = (units(batch.column("xa"), dim) * units(batch.column("xb"), dim)).sum(axis=1)
            ra, rb, angle = (batch.column(c).to_numpy().astype(np.float64) for c in ("ra", "rb", "angle"))
            plain = (batch.column("ka").to_numpy() == 1) & (batch.column("kb").to_numpy() == 1)
            sure = np.where(plain, dot >= cosine, angle + ra + rb <= theta - 2 * SLACK)
            ask = ~plain & ~sure
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb", "ka", "kb")), pa.array(sure)],
                                             names=["a", "b", "na", "nb", "ka", "kb", "sure"]).filter(pa.array(sure | ask))

    judged = stage(pairs.select("a", "b", "xa", "xb", "na", "nb", "ka", "kb", "ra", "rb", "angle").mapInArrow(
        verify, "a long, b long, na long, nb long, ka long, kb long, sure boolean"), "graph-judged")
    sure = judged.filter("sure")
    whole = sure.select(F.col("a").alias("uid"), F.col("nb").alias("more")).unionByName(sure.select(F.col("b").alias("uid"), F.col("na").alias("more")))

    def pieces(k):
        return F.ceil(F.col(k) / F.lit(float(MEMBERS))).cast("int")

    open_ = (judged.filter("not sure").withColumn("pa", pieces("ka")).withColumn("pb", pieces("kb"))
             .select("a", "b", "pa", "pb", F.explode(F.sequence(F.lit(0), F.col("pa") - 1)).alias("i"))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)).alias("j")))
    of = members.select(F.col("node"), F.col("uid"), F.col("x"), F.col("n"))
    spread = F.xxhash64("uid", F.lit(2))
    left = of.join(open_.withColumnRenamed("a", "node"), "node").filter(F.pmod(spread, "pa") == F.col("i")).select(F.col("node").alias("a"), "b", "i", "j", "uid", "x", "n")
    right = of.join(open_.withColumnRenamed("b", "node"), "node").filter(F.pmod(spread, "pb") == F.col("j")).select("a", F.col("node").alias("b"), "i", "j", "uid", "x", "n")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])

    def count(one: pa.Table, two: pa.Table) -> pa.Table:
        uid, more, a, b = [], [], [], []
        if one.num_rows and two.num_rows:
            u, v = units(one.column("x"), dim), units(two.column("x"), dim)
            nu, nv = one.column("n").to_numpy(), two.column("n").to_numpy()
            to_u, to_v = np.zeros(len(u), np.int64), np.zeros(len(v), np.int64)
            for lo in range(0, len(u), BLOCK):
                near = u[lo:lo + BLOCK] @ v.T >= cosine
                to_u[lo:lo + BLOCK] = near @ nv
                to_v += nu[lo:lo + BLOCK] @ near
            for t, to in ((one, to_u), (two, to_v)):
                some = np.flatnonzero(to)
                uid.append(t.column("uid").to_numpy()[some])
                more.append(to[some])
            if len(uid[0]):
                a, b = [one.column("a")[0].as_py()], [one.column("b")[0].as_py()]
        uid, more = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (uid, more))
        return pa.table({"uid": pa.concat_arrays([pa.array(uid, pa.int64()), pa.nulls(len(a), pa.int64())]),
                         "more": pa.concat_arrays([pa.array(more, pa.int64()), pa.nulls(len(a), pa.int64())]),
                         "a": pa.concat_arrays([pa.nulls(len(uid), pa.int64()), pa.array(a, pa.int64())]),
                         "b": pa.concat_arrays([pa.nulls(len(uid), pa.int64()), pa.array(b, pa.int64())])})

    by = ["a", "b", "i", "j"]
    counted = stage(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(count, "uid long, more long, a long, b long"), "graph-counted")
    links = sure.select("a", "b").unionByName(counted.filter("a is not null").select("a", "b").distinct())
    return links, whole, counted.filter("uid is not null").select("uid", "more")


def recall_of(kinds: DataFrame, result: DataFrame, total: int, dim: int, cosine: float) -> float:
    """Share of the true links of a hash sample of ``AUDIT`` kinds that the result counts."""
    asked = kinds.filter(F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, AUDIT / total) * (1 << 30))).select("uid", "x")
    asked = asked.toPandas()                                    # about ``AUDIT`` rows
    if not len(asked):
        return 1.0
    q = unit(np.array(asked["x"].tolist(), np.float64))
    shared = kinds.sparkSession.sparkContext.broadcast((asked["uid"].to_numpy(), q))

    def brute(batches):
        uid, q = shared.value
        total_ = np.zeros(len(q), np.int64)
        for batch in batches:
            u, n = units(batch.column("x"), dim), batch.column("n").to_numpy()
            for lo in range(0, len(u), BLOCK):
                total_ += n[lo:lo + BLOCK] @ (u[lo:lo + BLOCK] @ q.T >= cosine)
        some = np.flatnonzero(total_)
        yield pa.RecordBatch.from_arrays([pa.array(uid[some]), pa.array(total_[some])], names=["uid", "m"])

    true = kinds.select("x", "n").mapInArrow(brute, "uid long, m long").groupBy("uid").agg((F.sum("m") - 1).alias("m"))
    both = true.join(result.select("uid", "n_links"), "uid").agg(F.sum(F.least("m", "n_links")), F.sum("m")).first()
    return both[0] / both[1] if both[1] else 1.0


def near_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """One row per row of ``df``: ``vec_id``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (the id is that one)."""
    theta = math.acos(cosine)
    element = df.schema[vec_col].dataType.elementType.simpleString()
    xt = "array<float>" if element == "float" else "array<double>"
    x = F.col("x")
    fine = F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0),
                      F.lit(False))
    plain = F.transform(F.col(vec_col).cast(xt), lambda v: v + F.lit(0.0).cast("float" if xt == "array<float>" else "double"))     # no negative zero
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), plain.alias("x")).withColumn("size", F.when(fine, F.size(x)))
    common = rows.filter("size is not null").groupBy("size").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("size")).first()
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
    if common is None:
        return rows.select("vec_id", *alone)
    dim = common["size"]
    rows = rows.withColumn("k1", F.when(F.col("size") == dim, F.xxhash64("x"))).withColumn("k2", F.when(F.col("size") == dim, F.xxhash64(F.lit(1), "x")))
    grouped = rows.filter("k1 is not null").groupBy("k1", "k2").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))

    def number(batches):
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(uid + np.arange(batch.num_rows)), *batch.columns], names=["uid", *batch.schema.names])
            uid += batch.num_rows

    kinds = stage(grouped.select("k1", "k2", "x", "n", "first").mapInArrow(number, f"uid long, k1 long, k2 long, x {xt}, n long, first long"), "graph-kinds")
    total = kinds.count()
    balls = collapsed(kinds, dim, theta / 2 - SLACK)
    members = stage(kinds.join(balls, "uid", "left").withColumn("node", F.coalesce("medoid", "uid")).withColumn("angle", F.coalesce("angle", F.lit(0.0)))
                    .drop("medoid"), "graph-members")
    sizes = members.groupBy("node").agg(F.sum("n").alias("n"), F.max("angle").cast("float").alias("r"), F.min("first").alias("first"), F.count(F.lit(1)).alias("kinds"))
    nodes = stage(members.filter("uid = node").select("uid", "x").join(sizes.withColumnRenamed("node", "uid"), "uid"), "graph-nodes")
    if nodes.count() <= SHARD_MAX:
        trees = 1                                               # one shard holds them all
    while True:
        start = nodes.select("uid", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))).alias("home"))
        leaves, _ = grown(start, dim)
        first = leaves.filter(F.col("home").bitwiseAND(F.lit(TREE_BITS)) == 0)
        known = pairs_in_range(nodes, first, shard_graphs(leaves, nodes, dim), dim, theta)
        links, whole, single = linked(known, nodes, members, dim, cosine)
        whole, single = (t.groupBy("uid").agg(F.sum("more").alias(c)) for t, c in ((whole, "w"), (single, "s")))
        roots = components(links, "a", "b")
        named = nodes.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        names = named.groupBy("root").agg(F.min("first").alias("component_id"))
        per_node = (named.join(names, "root").join(whole, "uid", "left")
                    .select(F.col("uid").alias("node"), (F.col("n") - 1 + F.coalesce("w", F.lit(0))).alias("base"), "component_id"))
        result = stage(members.select("uid", "k1", "k2", "node").join(per_node, "node").join(single, "uid", "left")
                       .select("uid", "k1", "k2", (F.col("base") + F.coalesce("s", F.lit(0))).alias("n_links"), "component_id"), "graph-result")
        recall = recall_of(kinds, result, total, dim, cosine)
        if recall >= TARGET or trees == 1 or 2 * trees > MOST_TREES:
            break
        trees *= 2
    if recall < TARGET:
        warnings.warn(f"near_groups: audited recall {recall:.3f} of links with {trees} trees")
    out = rows.select("vec_id", "k1", "k2").join(result.drop("uid"), ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_flat_graph(spark, sf_dir: str) -> DataFrame:
    """Link number and component of every vector, at a cosine of 0.9."""
    return near_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# All pairs; components by repeated minima over links.
ORACLE = {"op11_flat_graph": f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    THEN CAST(embedding AS DOUBLE[]) END AS x FROM embeddings),
l AS (
  SELECT a.rid AS a, b.rid AS b FROM v AS a JOIN v AS b ON a.rid <> b.rid AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= {COSINE}),
reach(rid, other) AS (SELECT rid, rid FROM v UNION SELECT reach.rid, l.b FROM reach JOIN l ON l.a = reach.other),
c AS (SELECT reach.rid, min(v.vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.other GROUP BY reach.rid),
n AS (SELECT a AS rid, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (rid) LEFT JOIN n USING (rid)"""}
