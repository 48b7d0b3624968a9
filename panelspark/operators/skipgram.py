"""Skip-gram vectors with negative sampling (EMB-1) over vocabulary blocks.

Tokens are numbered by frequency and dealt over blocks of about ``block_rows``
(from eight on their number is a multiple of ``EVEN``, so that a step's cells fill the
cores evenly); both vector tables (tokens as centres, tokens as contexts) are stored
as staged tables, a row per ``PART`` vectors of a block, never on the driver.  A
pair (centre, context) lies in the cell of their two blocks.  Cells whose blocks
don't meet are trained side by side: in step ``s`` of a pass, centre block ``b``
meets context block ``(b + s) mod blocks``, so each task reads and updates two
blocks only and the steps of a pass cover all cells.  A cell's pairs are sorted by
their hashes and packed once, a row per piece of them; in each step pieces and vectors are
sent straight to the partition of their cell, as byte strings.  A cell of several times
``pairs_per_task`` pairs (times the number of blocks, up to ``WIDEST``: several cells
are trained side by side anyway, and each slice takes copies of its blocks along)
is cut into slices by pieces; every slice starts from the same blocks, and a
row's new vector is the mean over the slices weighted by how often each used it.

Within a task pairs are taken in a seeded order, ``GROUP`` pairs share
their negatives, which an alias table draws from the block's
``count ** power``, and updates are summed per mini-batch (a row used more than
``ROW_STEPS`` times in one counts that often).  Frequencies of pairs that lie
``d`` apart fall off as in the reference's trainer, whose window has a random
radius: a pair is used in a pass with probability ``(window - d + 1) / window``.

A pair's hash is one of (sentence, positions), every random choice comes from a
generator seeded by (seed, pass, step, block, slice), and pairs and rows are sorted
before use, so a result depends neither on partitioning nor on retried tasks.
"""

from __future__ import annotations

import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.indexing import global_index
from panelspark.operators.scratch import free, staged

_cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package

GROUP = 32
BATCH = 1_024
ROW_STEPS = 64
PART = 1_024               # vectors of a block in one row of a table
EVEN = 8
MAX_WINDOW = 2 ** 24 - 1   # low bits of a pair's hash that make room for its distance
WIDEST = 4                 # a cell's slices take up to this times more pairs where a step has that many cells
CHAIN = 4                  # steps run as one job, handing vectors on without a staged table
MAX_BROADCAST = 2_000_000  # tokens
BATCH_BYTES = "4m"         # of rows sent to Python at once: larger buffers are allocated anew for every batch
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MODEL = "kind int, block long, part int, vec binary, cut binary, alias binary"     # kind 0: centres, 1: contexts; single-precision numbers end to end
PIECES = "step long, bi long, sub long, piece int, n int, pairs binary"
SENT = pa.schema([("cell", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int32()),
                  *((c, pa.binary()) for c in ("vec", "cut", "alias"))])


def numbered_tokens(sent: DataFrame, col: str, min_count: int) -> DataFrame:
    """(token, id, count): tokens of at least ``min_count``, most frequent first."""
    counts = sent.select(F.explode(col).alias("token")).filter("token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return global_index(counts.filter(F.col("count") >= min_count), [F.desc("count"), "token"], "id")


def window_pairs(sent: DataFrame, col: str, window: int) -> DataFrame:
    """(centre, context, dist, h): every ordered pair at most ``window`` positions apart."""
    at = sent.select(F.col(col).alias("_toks"), F.xxhash64(col).alias("_h"), F.posexplode(col).alias("_i", "centre"))
    first = F.greatest(F.col("_i") - window, F.lit(0))
    near = at.select("centre", "_h", "_i", first.alias("_first"), F.posexplode(
        F.slice("_toks", first + 1, F.col("_i") - first + window + 1)).alias("_k", "context"))
    j = F.col("_first") + F.col("_k")
    return near.filter(j != F.col("_i")).select("centre", "context", F.abs(j - F.col("_i")).alias("dist"), F.xxhash64("_h", "_i", j).alias("h"))


def alias_table(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walker's alias method: a uniform row ``k`` stays with probability ``cut[k]``, else it becomes ``alias[k]``."""
    n = len(weights)
    p = weights * (n / weights.sum())
    cut, alias = np.ones(n), np.arange(n)
    small, large = [k for k in range(n) if p[k] < 1], [k for k in range(n) if p[k] >= 1]
    while small and large:
        s, g = small.pop(), large.pop()
        cut[s], alias[s] = p[s], g
        p[g] -= 1 - p[s]
        (small if p[g] < 1 else large).append(g)
    return cut.astype(np.float32), alias.astype(np.int32)


def _cut(numbers: np.ndarray, per: int) -> pa.Array:
    """An array's bytes as binary values of ``per`` rows each (the last one of the rest), not copied."""
    numbers = np.ascontiguousarray(numbers)
    n, width = len(numbers), numbers.itemsize * int(np.prod(numbers.shape[1:]))
    ends = (np.append(np.arange(0, n, per), n) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(numbers)])


def _parts(kind: int, block: int, vectors: np.ndarray, cut: np.ndarray | None = None, alias: np.ndarray | None = None) -> pa.Table:
    """A block's vectors as rows of ``MODEL``, ``PART`` of them in each."""
    vec = _cut(vectors, PART)
    n = len(vec)
    return pa.table({"kind": pa.array([kind] * n, pa.int32()), "block": pa.array([block] * n, pa.int64()), "part": pa.array(range(n), pa.int32()), "vec": vec,
                     "cut": pa.nulls(n, pa.binary()) if cut is None else _cut(cut, PART), "alias": pa.nulls(n, pa.binary()) if alias is None else _cut(alias, PART)})


def _joined(column, rows, kind) -> np.ndarray:
    """The numbers of a binary column's ``rows``, one after another, as an array of their own."""
    return np.concatenate([np.zeros(0, kind)] + [np.frombuffer(column[int(r)].as_buffer(), kind) for r in rows])


def first_model(tokens: DataFrame, blocks: int, dim: int, seed: int, power: float) -> DataFrame:
    """Both tables before training: small uniform centres, zero contexts with their alias table."""
    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        n, block = table.num_rows, table.column("block")[0].as_py()
        centres = ((np.random.default_rng([seed, block]).random((n, dim)) - 0.5) / dim).astype(np.float32)
        cut, alias = alias_table(table.column("count").to_numpy().astype(np.float64) ** power)
        return pa.concat_tables([_parts(0, block, centres), _parts(1, block, np.zeros((n, dim), np.float32), cut, alias)])

    return tokens.select("block", "at", "count").groupBy("block").applyInArrow(fill, MODEL)


def _add_rows(table: np.ndarray, rows: np.ndarray, change: np.ndarray, uses: np.ndarray) -> None:
    order = rows.argsort(kind="stable")
    put = rows[order]
    head = np.flatnonzero(np.concatenate([[True], put[1:] != put[:-1]]))
    factor = np.minimum(1.0, ROW_STEPS / np.maximum(1.0, np.add.reduceat(uses[order], head))).astype(np.float32)
    table[put[head]] += np.add.reduceat(change[order], head, axis=0) * factor[:, None]


def _apply(table: np.ndarray, slots: np.ndarray, rows: np.ndarray, old: np.ndarray, change: np.ndarray, uses: np.ndarray,
           seen: np.ndarray, at: np.ndarray) -> None:
    """``_add_rows``, which is left the rows that occur in the batch again; ``old`` holds the rows as they are (it is written over).
    ``slots``: the table with a row as one item; ``at``: 0, 1, 2...; ``seen``: room for a number per row of the table."""
    seen[rows] = at
    lost = seen[rows] != at
    old += change
    if lost.any():
        seen[rows[lost]] = -1
        often = np.flatnonzero(seen[rows] < 0)
        again = rows[often]
        before = slots[again]
        slots[rows] = old.view(slots.dtype).ravel()
        slots[again] = before
        _add_rows(table, again, change[often], uses[often])
    else:
        slots[rows] = old.view(slots.dtype).ravel()


def train_cell(centre: np.ndarray, context: np.ndarray, u: np.ndarray, v: np.ndarray, cut: np.ndarray, alias: np.ndarray,
               rates: tuple[float, float], negative: int, rng: np.random.Generator) -> None:
    """One pass over the pairs; updates ``u`` (centres) and ``v`` (contexts) in place."""
    batch = min(BATCH, max(GROUP, 2 * min(len(u), len(v)) // GROUP * GROUP))
    dim = u.shape[1]
    slot = np.dtype((np.void, u.itemsize * dim))
    u_slots, v_slots = u.view(slot).ravel(), v.view(slot).ravel()
    seen_u, seen_v = np.zeros(len(u), np.int32), np.zeros(len(v), np.int32)
    most = batch + -(-batch // GROUP) * negative
    room = [np.empty((most, dim), np.float32) for _ in range(4)]
    more = np.empty((batch, dim), np.float32)
    at = np.arange(most, dtype=np.int32)
    for lo in range(0, len(centre), batch):
        a, b = centre[lo:lo + batch], context[lo:lo + batch]
        rate = np.float32(rates[0] + (rates[1] - rates[0]) * lo / len(centre))
        n, groups = len(a), -(-len(a) // GROUP)
        k = rng.integers(0, len(v), (groups, negative))
        neg = np.where(rng.random(k.shape) < cut[k], k, alias[k])
        rows = np.concatenate([b, neg.ravel()])
        ua, va, change_u, change_v = (x[:m] for x, m in zip(room, (n, len(rows), n, len(rows))))
        u_slots.take(a, out=ua.view(slot).ravel(), mode="clip")
        v_slots.take(rows, out=va.view(slot).ravel(), mode="clip")
        vb, vn = va[:n], va[n:].reshape(groups, negative, dim)
        up = (rate / (1 + np.exp(np.clip(np.einsum("ij,ij->i", ua, vb), -30, 30))))[:, None]             # towards the context
        uses = np.ones(len(rows))
        whole = n // GROUP
        for g, size in ((slice(0, whole), GROUP), (slice(whole, groups), n - whole * GROUP)):
            if g.start == g.stop:
                continue
            part = slice(g.start * GROUP, g.start * GROUP + (g.stop - g.start) * size)
            x, y, to_v = ua[part].reshape(-1, size, dim), vn[g], change_v[n:].reshape(vn.shape)[g]
            down = x @ y.transpose(0, 2, 1)
            np.clip(down, -30, 30, out=down)
            np.exp(np.negative(down, out=down), out=down)
            down += 1
            np.divide(-rate, down, out=down)                                                    # away from the negatives
            down[neg[g, None, :] == b[part].reshape(-1, size, 1)] = 0
            np.matmul(down, y, out=change_u[part].reshape(x.shape))
            np.matmul(down.transpose(0, 2, 1), x, out=to_v)
            uses[n:].reshape(neg.shape)[g] = size           # a negative stands for all pairs of its group
        np.multiply(ua, up, out=change_v[:n])
        change_u += np.multiply(vb, up, out=more[:n])
        _apply(u, u_slots, a, ua, change_u, uses, seen_u, at[:n])
        _apply(v, v_slots, rows, va, change_v, uses, seen_v, at[:len(rows)])


def _pack(piece: int, subs: int, blocks: int, window: int):
    """A sub-cell's pairs in the order of their hashes, ``piece`` of them in a row."""
    small = np.min_scalar_type(window)

    def work(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        h, pair = table.column("h").to_numpy(), table.column("pair").to_numpy()
        order = np.argsort(h)
        if (np.diff(h[order]) == 0).any():
            order = np.lexsort((pair, h))
        pair, dist = pair[order], (h[order] & MAX_WINDOW).astype(small)
        a, b = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
        starts = range(0, len(pair), piece)
        rows = [b"".join(x[lo:lo + piece].tobytes() for x in (a, b, dist)) for lo in starts]
        return pa.table({"step": pa.array([cell // subs // blocks] * len(rows), pa.int64()), "bi": pa.array([cell // subs % blocks] * len(rows), pa.int64()),
                         "sub": pa.array([cell % subs] * len(rows), pa.int64()), "piece": pa.array(range(len(rows)), pa.int32()),
                         "n": pa.array([len(x) // (8 + small.itemsize) for x in rows], pa.int32()), "pairs": pa.array(rows, pa.binary())})
    return work


def _drawn(column, rows, window: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a pass, in a random order; one that lies ``d`` apart is used with probability ``(window - d + 1) / window``."""
    found, small = [(np.zeros(0, np.int32),) * 2], np.min_scalar_type(window)
    for r in rows:
        data = column[int(r)].as_buffer()
        n = data.size // (8 + small.itemsize)
        a, b = np.frombuffer(data, np.int32, 2 * n).reshape(2, n)
        near = rng.random(n) * window < window + 1.0 - np.frombuffer(data, small, n, 8 * n)
        found.append((a[near], b[near]))
    a, b = (np.concatenate(x) for x in zip(*found))
    order = rng.permutation(len(a))
    return a[order].astype(np.int64), b[order].astype(np.int64)


def _step_task(dim: int, window: int, negative: int, seed: int, epoch: int, step: int, width: int, rates: tuple[float, float]):
    def work(batches):
        rows = pa.Table.from_batches(batches, SENT).combine_chunks()
        if not rows.num_rows:
            return
        kind, block, part = (rows.column(c).to_numpy() for c in ("kind", "block", "part"))
        order = np.lexsort((part, block, kind))
        centres, contexts, pieces = (order[kind[order] == k] for k in range(3))
        u, v = (_joined(rows.column("vec"), x, np.float32).reshape(-1, dim) for x in (centres, contexts))
        cut, alias = _joined(rows.column("cut"), contexts, np.float32), _joined(rows.column("alias"), contexts, np.int32)
        bi, part_of = divmod(rows.column("cell")[0].as_py(), width)
        a = b = np.zeros(0, np.int64)
        if len(pieces) and len(u) and len(v):
            rng = np.random.default_rng([seed, epoch, step, bi, part_of])
            a, b = _drawn(rows.column("vec"), pieces, window, rng)
            train_cell(a, b, u, v, cut, alias.astype(np.int64), rates, negative, rng)
        for k, x, at, extra in ((0, u, a, (None, None)), (1, v, b, (cut, alias))):
            if len(x):
                out = _parts(k, int(block[(centres, contexts)[k][0]]), x, *extra)
                if width > 1:
                    out = out.append_column("slice", pa.array([part_of] * out.num_rows, pa.int32())).append_column(
                        "used", _cut(np.bincount(at, minlength=len(x)), PART))
                yield from out.to_batches(max_chunksize=8)
    return work


def _average(dim: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        every = range(table.num_rows)
        used = _joined(table.column("used"), every, np.int64).reshape(len(every), -1)
        vec = _joined(table.column("vec"), every, np.float32).reshape(len(every), -1, dim)
        weight = np.where(used.sum(axis=0) == 0, 1, used).astype(np.float64)
        mean = (vec * weight[:, :, None]).sum(axis=0) / weight.sum(axis=0)[:, None]
        first = table.slice(0, 1)
        return pa.table({c: pa.array([mean.astype(np.float32).tobytes()], pa.binary()) if c == "vec" else first.column(c)
                         for c in ("kind", "block", "part", "vec", "cut", "alias")})
    return work


def train_skipgram(sent: DataFrame, col: str = "tokens", vector_size: int = 100, window: int = 5, min_count: int = 1,
                   epochs: int = 10, negative: int = 10, seed: int = 42, alpha: float = 0.025, min_alpha: float = 1e-4,
                   power: float = 0.75, block_rows: int = 131_072, pairs_per_task: int = 500_000) -> DataFrame:
    """EMB-1: (token, vector ARRAY<DOUBLE>) of every token with ``min_count`` occurrences.

    A task holds two blocks of ``block_rows`` vectors and ``pairs_per_task`` pairs (about; up to ``WIDEST`` times as many);
    every step sends both tables on, every ``CHAIN`` steps write them anew, and a pass has as many steps as blocks;
    the rate falls from ``alpha`` to ``min_alpha`` over all steps.  Tokens below
    ``min_count`` keep their place in the window but are not trained; null
    tokens and tokens of one-token sentences have no pairs.  No sentence: no rows."""
    if not hasattr(sent, "_staged_path"):
        sent = staged(sent.select(col), "skipgram-sentences")         # read by the counts and the pairs
    tokens = numbered_tokens(sent, col, min_count)
    size = tokens.count()
    spark = sent.sparkSession
    if size == 0:
        return spark.createDataFrame([], "token string, vector array<double>")
    blocks = -(-size // block_rows)
    if blocks >= EVEN:
        blocks = EVEN * round(size / block_rows / EVEN)
    tokens = staged(tokens.select("token", "count", (F.col("id") % blocks).alias("block"), F.expr(f"cast(id div {blocks} as int)").alias("at")), "skipgram-tokens")
    model = staged(first_model(tokens, blocks, vector_size, seed, power), "skipgram-model", compression="uncompressed")     # numbers that don't shrink

    def side(token, block, at):
        t = tokens.select(F.col("token").alias(token), F.col("block").alias(block), F.col("at").alias(at))
        return F.broadcast(t) if size <= MAX_BROADCAST else t

    reach = F.least(F.lit(window), F.size(col) - 1).cast("long")
    most = sent.filter(F.size(col) > 1).agg(F.sum(2 * reach * F.size(col) - reach * (reach + 1))).scalar()     # pairs, those of untrained tokens too
    subs = sent.select(F.ceil(F.coalesce(most, F.lit(0)) / F.lit(float(pairs_per_task * blocks * blocks)))).first()
    subs = max(1, subs[0] if subs else 1)
    pairs = window_pairs(sent, col, window).join(side("centre", "bi", "ai"), "centre").join(side("context", "bj", "aj"), "context")
    cell = (F.pmod(F.col("bj") - F.col("bi"), F.lit(blocks)) * blocks + F.col("bi")) * subs + F.pmod("h", F.lit(subs))
    pairs = pairs.select(cell.alias("cell"), F.expr("shiftleft(cast(ai as long), 32) + aj").alias("pair"), F.expr(f"(h & ~{MAX_WINDOW}L) | dist").alias("h"))
    pairs = staged(pairs.groupBy("cell").applyInArrow(_pack(max(1, pairs_per_task // 8), subs, blocks, window), PIECES), "skipgram-pairs", ["step"])
    share = F.sum("n") / F.lit(float(pairs_per_task * min(blocks, WIDEST)))
    cells = staged(pairs.groupBy("step", "bi").agg(F.greatest(F.round(share), F.lit(1)).cast("int").alias("n")), "skipgram-cells")
    widest = {r["step"]: r["m"] for r in cells.groupBy("step").agg(F.max("n").alias("m")).collect()}       # a row per block
    total, last = epochs * blocks, model
    behind, gone = ThreadPoolExecutor(1), None           # large files take seconds to delete
    batch_bytes = spark.conf.get(_BYTES, None)
    for epoch in range(epochs):
        for step in range(blocks):
            if step not in widest:
                continue
            done, width = epoch * blocks + step, widest[step]
            rates = tuple(alpha + (min_alpha - alpha) * x / total for x in (done, done + 1))
            meets = F.when(F.col("kind") == 0, F.col("block")).otherwise(F.pmod(F.col("block") - step, F.lit(blocks)))
            rows, now = model.withColumn("bi", meets), pairs.filter(F.col("step") == step)
            if width > 1:
                sizes = F.broadcast(cells.filter(F.col("step") == step).select("bi", F.col("n").alias("slices")))
                rows = rows.join(sizes, "bi", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
                now = now.join(sizes, "bi").withColumn("slice", F.pmod(F.col("sub") + F.col("piece"), "slices"))
            place = F.col("bi") * width + (F.col("slice") if width > 1 else 0)
            none = F.lit(None).cast("binary")
            sent_on = rows.select(place.cast("int").alias("cell"), "kind", "block", "part", "vec", "cut", "alias").union(
                now.select(place.cast("int"), F.lit(2), "sub", "piece", "pairs", none, none))
            new = sent_on.repartitionById(blocks * width, F.col("cell")).mapInArrow(
                _step_task(vector_size, window, negative, seed, epoch, step, width, rates), MODEL + (", slice int, used binary" if width > 1 else ""))
            if width > 1:
                new = new.groupBy("kind", "block", "part").applyInArrow(_average(vector_size), MODEL)
            model = new
            if (step + 1) % CHAIN == 0 or step == max(widest):
                spark.conf.set(_BYTES, BATCH_BYTES)
                try:
                    model = staged(new, "skipgram-model", compression="uncompressed")
                finally:
                    spark.conf.unset(_BYTES) if batch_bytes is None else spark.conf.set(_BYTES, batch_bytes)
                if gone:
                    gone.result()
                gone, last = behind.submit(free, last), model
    if gone:
        gone.result()
    behind.shutdown()
    free(pairs, cells)

    def unpack(batches):
        for batch in batches:
            for names, vec in zip(batch.column("tokens"), batch.column("vec")):
                x = np.frombuffer(vec.as_buffer(), np.float32).astype(np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1, dtype=np.int32) * vector_size), pa.array(x))
                yield pa.RecordBatch.from_arrays([names.values, lists], names=["token", "vector"])

    names = tokens.groupBy("block", F.expr(f"at div {PART}").cast("int").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "token"))).alias("t")).select("block", "part", F.col("t.token").alias("tokens"))
    return (model.filter("kind = 0").select("block", "part", "vec").join(names, ["block", "part"])
            .mapInArrow(unpack, "token string, vector array<double>"))
