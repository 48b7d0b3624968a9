"""OP 6: repeated byte strings by suffix arrays of content-defined shards.

A byte goes if it lies in a string of ``length`` bytes that also starts
anywhere else in the corpus.  Every such string (a window) is in the shard of its
minimiser, the least hash of its ``GRAM``-byte strings, so equal windows
meet.  Runs of windows with one minimiser travel as one stretch of text:

1. scan: each text's runs (start, windows, minimiser, hash of the stretch);
2. runs whose minimiser occurs once in the corpus can repeat nothing and are
   done; equal stretches are counted, not moved: where one occurs twice, all
   its windows repeat;
3. the different stretches of one minimiser, one copy of each, form a
   shard (small ones share one).  Its suffix array holds the suffixes that begin
   a window, sorted by their first ``length`` bytes, and windows whose
   suffixes share these with a neighbour repeat;
4. a minimiser with more than ``GROUP`` different stretches is dealt out over
   several shards; each distinct window found there is compared across those
   shards by its 128-bit hash;
5. the removed runs of each text are joined to it and cut out.

``strip_repeats`` also cuts passages of ``words`` words, whatever their bytes, if asked:
the same steps run over texts whose words are codes of ``CODE`` bytes (42 bits
of a hash), with a length of ``words`` codes; ranges that begin or end
inside a code count from the next or to the last whole one.  The two passes run
one after the other; each frees its staged tables when its ranges are written.

Texts are told apart by two 64-bit hashes; copies share their result, so they
are never paired.  Null texts count as empty; texts shorter than ``length``
keep all; repeated rows are copies of each other; null ids are allowed;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import word_tokens as WT
from panelspark.llm.common import byte_slices, partitions, release, ship
from panelspark.operators.scratch import free, staged

ship(__name__)

LENGTH = 400
GRAM = 64
MAX_WINDOWS = 512          # of a run before it is cut in two (only repetitive text has longer ones)
GROUP = 24                 # different stretches of a minimiser per shard
SHARD_BYTES = 8_192        # small groups share a shard up to this
BATCH_BYTES = 1 << 20      # of shards whose results are given off together
CODE = 6                   # bytes of a word's code, seven bits each
CODE_GRAM = 32
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_SLICE = 4 << 20
_PIECE = 1 << 18


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position, by doubling."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for lo in range(0, n, _PIECE):
        h = (data[lo:lo + _PIECE + gram - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        factor, width = 0xD6E8FEB86659FD93, 1
        while width < gram:
            h = h[:-width] * np.uint64(factor) + h[width:]
            factor = factor * factor % (1 << 64)
            width *= 2
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xA0761D6478BD642F)
        h ^= h >> np.uint64(29)
        out[lo:lo + _PIECE] = h
    return out


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours: block-wise minima from both sides."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    full = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:len(h)] = h
    grid = full.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one minimiser: text, start in it, windows,
    minimiser and whether the run's stretch holds it at several places."""
    grams = gram_hashes(data, gram)
    low = window_minima(grams, length - gram + 1)
    size = np.diff(offsets)
    windows = np.maximum(0, size - length + 1)
    has = np.flatnonzero(windows)
    if not len(has):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), np.zeros(0, bool)
    inside = np.zeros(len(low) + 1, np.int8)
    np.add.at(inside, offsets[:-1][has], 1)
    np.add.at(inside, offsets[:-1][has] + windows[has], -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]) & inside)
    head = np.union1d(change, offsets[:-1][has])
    text = np.searchsorted(offsets, head, side="right") - 1
    stop = offsets[:-1][text] + windows[text]
    end = np.minimum(np.append(head[1:], len(low)), stop)
    count = end - head
    cut = -(-count // MAX_WINDOWS)
    nth = np.arange(int(cut.sum())) - np.repeat(np.cumsum(cut) - cut, cut)
    start = np.repeat(head, cut) + nth * MAX_WINDOWS
    count = np.minimum(MAX_WINDOWS, np.repeat(end, cut) - start)
    text = np.repeat(text, cut)
    value = low[start]
    ends = (start + count + length - gram).tolist()
    twice = np.fromiter((np.count_nonzero(grams[a:b] == v) > 1 for a, b, v in zip(start.tolist(), ends, value)), bool, len(start))
    return text, start - offsets[:-1][text], count, value, twice


def scan(df: DataFrame, keep: list[str], text_col: str, length: int, gram: int) -> DataFrame:
    """Staged: the kept columns, ``k1``, ``k2`` (the text's hashes),
    ``n_bytes``, ``sha`` and the runs of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("row_"), text.alias("text_"),
                    F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))

    def task(batches):
        import xxhash
        for batch in batches:
            for part in byte_slices(batch, 1, _SLICE):
                raw = [t.encode() for t in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, raw)])
                flat = b"".join(raw)
                text_, start, count, low, twice = runs_of(np.frombuffer(flat, np.uint8), offsets, length, gram)
                at = (offsets[:-1][text_] + start).tolist()
                own = [xxhash.xxh3_64_intdigest(flat[a:b]) for a, b in zip(at, (np.array(at, np.int64) + count + length - 1).tolist())]
                bounds = pa.array(np.searchsorted(text_, np.arange(len(raw) + 1)).astype(np.int32))

                def lists(values):
                    return pa.ListArray.from_arrays(bounds, pa.array(values))

                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), part.column(3), pa.array(np.diff(offsets)),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                    lists(start.astype(np.int32)), lists(count.astype(np.int32)), lists(low.view(np.int64)),
                    lists(np.array(own, np.uint64).view(np.int64)), lists(twice),
                ], names=["row_", "k1", "k2", "n_bytes", "sha", "start", "count", "low", "own", "twice"])
        release()

    names = {"start": "int", "count": "int", "low": "bigint", "own": "bigint", "twice": "boolean"}
    ddl = f"row_ {src.schema['row_'].dataType.simpleString()}, k1 long, k2 long, n_bytes long, sha string, " + ", ".join(
        f"{c} array<{t}>" for c, t in names.items())
    return staged(src.mapInArrow(task, ddl), "suffix-scan")


def repeats_in_shard(shard: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each stretch of a shard and each of its windows: how many
    windows of the shard are equal to it, and the rank of the first in the
    suffix array (equal windows share it): arrays (count, rank).

    The array holds the suffixes that begin a window, in the order of their first ``length`` bytes."""
    suffixes = []
    for x in shard:
        x = x.decode("latin-1")                                # a character a byte, in the bytes' order
        suffixes += [x[i:i + length] for i in range(len(x) - length + 1)]
    array = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    in_order = [suffixes[i] for i in array]
    head = np.fromiter(map(ne, in_order, [None, *in_order[:-1]]), bool, len(array))     # shares less than ``length`` with the one before
    label = np.cumsum(head) - 1
    count, rank = np.empty(len(array), np.int64), np.empty(len(array), np.int64)
    count[array] = np.bincount(label)[label]
    rank[array] = label
    ends = np.cumsum([len(x) - length + 1 for x in shard])[:-1]
    return list(zip(np.split(count, ends), np.split(rank, ends)))


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of True as (first, past last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


FOUND = "k1 long, k2 long, a int, b int, h1 long, h2 long"


def shard_task(length: int):
    """Rows (low, part, split, n_occ, k1, k2, start, content), those of a
    (low, part) together -> removed byte ranges, and for split groups
    the hash of each distinct window that is still single (with its place)
    or already known to repeat (without)."""

    def work(batches):
        import xxhash

        def solve(groups):
            inside, single, known = [], [], []         # columns of whole ranges, of windows that are single here, of those known to repeat
            shards, held = [[]], 0
            for rows in groups:
                size = sum(len(r[6]) for r in rows)
                if shards[-1] and held + size > SHARD_BYTES:
                    shards.append([])
                    held = 0
                shards[-1] += rows
                held += size
            for rows in shards:
                told = np.zeros(0, np.int64)
                for (split, n_occ, k1, k2, start, _, content), (count, rank) in zip(rows, repeats_in_shard([r[6] for r in rows], length)):
                    if n_occ == 1:
                        inside += [(k1, k2, start + a, start + b + length - 1) for a, b in stretches(count > 1)]
                    if split:
                        again = (count > 1) if n_occ == 1 else np.ones(len(count), bool)
                        ranks, first = np.unique(rank[again], return_index=True)
                        new = ~np.isin(ranks, told)
                        told = np.concatenate([told, ranks[new]])
                        known.append(hashes(content, np.flatnonzero(again)[first[new]]))
                        alone = np.flatnonzero(~again)
                        h = hashes(content, alone)
                        at = start + alone
                        single.append((np.full(len(at), k1), np.full(len(at), k2), at, at + length, h[:, 0], h[:, 1]))
            found = [np.concatenate(c) for c in zip(*single)] if single else [np.zeros(0, np.int64)] * 6
            repeat = np.concatenate([np.zeros((0, 2), np.int64), *known])
            ranges = [np.array(c, np.int64) for c in zip(*inside)] if inside else [np.zeros(0, np.int64)] * 4
            cols = [pa.concat_arrays([pa.array(a.astype(t)), pa.array(b.astype(t)), pa.nulls(len(repeat), pa.from_numpy_dtype(t))])
                    for a, b, t in zip(ranges, found, (np.int64, np.int64, np.int32, np.int32))]
            cols += [pa.concat_arrays([pa.nulls(len(ranges[0]), pa.int64()), pa.array(found[4 + i]), pa.array(np.ascontiguousarray(repeat[:, i]))])
                     for i in (0, 1)]
            return pa.RecordBatch.from_arrays(cols, names=["k1", "k2", "a", "b", "h1", "h2"])

        def hashes(content, at):
            raw = b"".join([xxhash.xxh3_128_digest(content[i:i + length]) for i in at.tolist()])
            return np.frombuffer(raw, "<i8").reshape(-1, 2)

        groups, last, held = [], None, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512).to_pydict()
                for key in zip(*(rows[c] for c in ("low", "part", "split", "n_occ", "k1", "k2", "start", "count", "content"))):
                    if last != key[:2]:
                        if held > BATCH_BYTES:
                            yield solve(groups)
                            groups, held = [], 0
                        groups.append([])
                        last = key[:2]
                    groups[-1].append(key[2:])
                    held += len(key[8])
        if groups:
            yield solve(groups)
        release()

    return work


def repeated_ranges(df: DataFrame, scanned: DataFrame, text_col: str, length: int) -> DataFrame:
    """Staged: (k1, k2, ranges: array<struct<a, b>>) of bytes to remove per text."""
    spark = df.sparkSession
    runs = (scanned.select("k1", "k2", F.explode(F.arrays_zip("start", "count", "low", "own", "twice")).alias("r"))
            .select("k1", "k2", "r.*"))
    # the tables of minimisers are cut off their aggregations, so that the joins with them can split hot minimisers
    often = staged(runs.groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("t")).filter("n > 1 or t").select("low"), "suffix-often")
    runs = staged(runs.join(often, "low"), "suffix-runs")
    free(often)
    kinds = staged(runs.groupBy("low", "own", "count")
                   .agg(F.count(F.lit(1)).alias("n_occ"), F.max("twice").alias("twice"), F.min(F.struct("k1", "k2", "start")).alias("place")), "suffix-kinds")
    several = staged(kinds.groupBy("low").agg(F.count(F.lit(1)).alias("d"), F.max("twice").alias("t"))
                     .filter("d > 1 or t").select("low", "d"), "suffix-several")
    need = kinds.join(several, "low").select("low", "own", "count", "n_occ", "d", "place.k1", "place.k2", "place.start")
    # texts that stretches are taken from, once each
    asked = need.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "own", "count", "n_occ", "d", "start")).alias("asked"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = (df.select(text.alias("text_"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
             .filter(F.octet_length("text_") >= length)
             .groupBy("k1", "k2").agg(F.first("text_").alias("text_")))
    texts = staged(texts.join(asked, ["k1", "k2"]), "suffix-texts")      # one Python worker a task at a time
    free(several)

    def take(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, _SLICE):
                cols = [[] for _ in range(9)]
                for k1, k2, t, asked_ in zip(*(part.column(i).to_pylist() for i in range(4))):
                    raw = t.encode()
                    for r in asked_:
                        parts = -(-r["d"] // GROUP)
                        for c, v in zip(cols, (r["low"], r["own"] % parts, parts > 1, r["n_occ"], k1, k2, r["start"], r["count"],
                                               raw[r["start"]:r["start"] + r["count"] + length - 1])):
                            c.append(v)
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[
                    "low", "part", "split", "n_occ", "k1", "k2", "start", "count", "content"])
        release()

    content = (texts.select("k1", "k2", "text_", "asked").mapInArrow(
        take, "low long, part long, split boolean, n_occ long, k1 long, k2 long, start int, count int, content binary")
        .repartition(partitions(spark), "low", "part").sortWithinPartitions("low", "part"))
    found = staged(content.mapInArrow(shard_task(length), FOUND), "suffix-found")
    free(texts)
    # whole runs of which the corpus has an equal one
    whole = (runs.join(kinds.filter("n_occ > 1").select("low", "own", "count"), ["low", "own", "count"], "left_semi")
             .select("k1", "k2", F.col("start").alias("a"), (F.col("start") + F.col("count") + length - 1).alias("b")))
    inside = found.filter("h1 is null").select("k1", "k2", "a", "b")
    hashed = found.filter("h1 is not null")
    both = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    across = hashed.filter("k1 is not null").join(both, ["h1", "h2"], "left_semi").select("k1", "k2", "a", "b")
    ranges = staged(whole.unionByName(inside).unionByName(across).distinct()
                    .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("ranges")), "suffix-ranges")
    free(runs, kinds, found)
    return ranges


def merged(ranges: list[dict], touching: bool = True) -> list[tuple[int, int]]:
    """Sorted ranges as maximal runs; those that only touch are one, if asked for."""
    out: list[list[int]] = []
    for r in ranges:
        if out and r["a"] < out[-1][1] + touching:
            out[-1][1] = max(out[-1][1], r["b"])
        else:
            out.append([r["a"], r["b"]])
    return [(a, b) for a, b in out]


def word_codes(df: DataFrame, text_col: str) -> DataFrame:
    """``t1``, ``t2`` (the text's hashes) and ``code``: its words' codes end to end."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text_"))

    def task(batches):
        import xxhash
        for batch in batches:
            for part in byte_slices(batch, 2, _SLICE):
                words, index, offsets = WT.split_words(part.column(2))
                h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
                codes = np.stack([(h >> np.uint64(7 * k)) & np.uint64(0x7F) for k in range(CODE)], axis=1).astype(np.uint8)
                index = index.to_numpy()
                some = (np.array([w != "" for w in words.to_pylist()], bool)[index] if len(words) else np.zeros(0, bool))
                before = np.concatenate([[0], np.cumsum(some)])[offsets] * CODE      # of a slice: fits 32 bits
                data = codes[index[some]].tobytes()
                code = pa.StringArray.from_buffers(part.num_rows, pa.py_buffer(before.astype(np.int32).tobytes()), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), code], names=["t1", "t2", "code"])
        release()

    return src.mapInArrow(task, "t1 long, t2 long, code string")


def repeated_passages(df: DataFrame, text_col: str, words: int) -> DataFrame:
    """Staged: (k1, k2, passages: array<struct<a, b>>): ranges of each text's codes that repeat."""
    coded = staged(word_codes(df, text_col), "suffix-codes")      # one Python worker a task at a time
    scanned = scan(coded, ["t1", "t2"], "code", words * CODE, CODE_GRAM)
    ranges = repeated_ranges(coded, scanned, "code", words * CODE)
    free(coded)
    passages = staged(scanned.select("row_.t1", "row_.t2", "k1", "k2").distinct().join(ranges, ["k1", "k2"])
                      .select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), F.col("ranges").alias("passages")), "suffix-passages")
    free(scanned, ranges)
    return passages


def passage_bytes(raw: bytes, passages: list[dict], words: int) -> list[dict]:
    """Ranges of codes as byte ranges of the text, from a first to a last word."""
    at = [m.span() for m in WORD.finditer(raw)]
    whole = [(-(-a // CODE), b // CODE) for a, b in merged(passages, touching=False)]     # white space between two stays
    return [{"a": at[a][0], "b": at[b - 1][1]} for a, b in whole if b - a >= words]


def removals(df: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
             with_text: bool = True, words: int | None = None) -> DataFrame:
    """Texts that lose something: ``k1``, ``k2``, ``n_removed``, ``n_spans``,
    ``kept_sha`` and, if asked for, ``spans`` (removed byte ranges), ``kept``
    (the other bytes) and ``kept_text`` (their whole characters)."""
    scanned = scan(df, [], text_col, length, gram)
    ranges = repeated_ranges(df, scanned, text_col, length)
    free(scanned)
    if words:
        # a text that loses passages may have no window of ``length`` bytes
        passages_ = repeated_passages(df, text_col, words)
        both = staged(ranges.join(passages_, ["k1", "k2"], "full"), "suffix-both")
        free(ranges, passages_)
        ranges = both
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = (df.select(text.alias("text_"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
             .join(ranges.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text_").alias("text_")))

    def cut(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, _SLICE):
                cols = [[] for _ in range(6)]
                for t, r, p in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                    raw = t.encode()
                    runs = merged(sorted([*(r or ()), *(passage_bytes(raw, p, words) if p else ())], key=lambda x: (x["a"], x["b"])))
                    at, kept = 0, []
                    for a, b in runs:
                        kept.append(raw[at:a])
                        at = b
                    kept = b"".join([*kept, raw[at:]])
                    for c, v in zip(cols, (len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                                           [{"a": a, "b": b} for a, b in runs] if with_text else None, kept if with_text else None,
                                           kept.decode("utf-8", "ignore") if with_text else None)):
                        c.append(v)
                types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(c, t) for c, t in zip(cols, types)]], names=[
                    "k1", "k2", "n_removed", "n_spans", "kept_sha", "spans", "kept", "kept_text"])

    passages = F.col("passages") if words else F.lit(None).cast("array<struct<a:int,b:int>>")
    joined = staged(texts.join(ranges, ["k1", "k2"]).select("k1", "k2", "text_", "ranges", passages.alias("passages")), "suffix-cuts")
    free(ranges)
    return (joined.mapInArrow(
        cut, "k1 long, k2 long, n_removed long, n_spans long, kept_sha string, spans array<struct<a:int,b:int>>, kept binary, kept_text string"))


def rows_and_cuts(df: DataFrame, text_col: str, done: DataFrame) -> DataFrame:
    """All rows of ``df`` as ``row_``, their text as ``text_`` and, where it loses something, the columns of ``done``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row_"), text.alias("text_"),
                     F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    return rows.join(done, ["k1", "k2"], "left")


def remove_repeats(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, length: int = LENGTH,
                   gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """The columns ``keep``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, ``kept_text`` (whole characters of what is left) and, if
    asked for, ``spans`` and ``kept`` of ``removals`` (null where nothing was removed)."""
    if length < gram or gram & (gram - 1):
        raise ValueError("gram must be a power of two, and length at least gram")
    out = rows_and_cuts(df, text_col, removals(df, text_col, length, gram))
    zero = F.lit(0).cast("long")
    cols = [F.col("row_").getField(c).alias(c) for c in keep or []] + [
        F.octet_length("text_").cast("long").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha", F.sha2("text_", 256)).alias("kept_sha256"),
        F.coalesce("kept_text", "text_").alias("kept_text")]
    return out.select(*cols, *(["spans", "kept"] if with_text else []))


def strip_repeats(df: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, words: int | None = None) -> DataFrame:
    """``df`` with the repeated strings of ``length`` bytes and, if asked for,
    the repeated passages of ``words`` words cut out of its texts (characters that a
    cut splits go too) and without the rows of which only white space is left."""
    done = removals(df, text_col, length, gram, words=words).select("k1", "k2", F.col("kept_text").alias("kept_text_"))
    cut = rows_and_cuts(df, text_col, done).filter(F.col("kept_text_").isNull() | (F.trim(F.col("kept_text_")) != ""))
    return cut.select(*[(F.coalesce("kept_text_", F.col("row_").getField(c)) if c == text_col else F.col("row_").getField(c)).alias(c)
                        for c in df.columns])


def op6_suffix_shards(spark, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 400 bytes that occur elsewhere, and the text that is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep=["doc_id"], with_text=False).withColumnRenamed("kept_text", "text")


# Every window by its MD5; runs of removed bytes as islands of repeated starts.
# Text: whole characters of the bytes left, bytes of no whole character dropped.
_CHARACTER = ("[0-7][0-9A-F]|(?:C[2-9A-F]|D[0-9A-F])[89AB][0-9A-F]|(?:E0[AB]|ED[89]|E[1-9A-CEF][89AB])[0-9A-F][89AB][0-9A-F]"
              "|(?:F0[9AB]|F[1-3][89AB]|F48)[0-9A-F][89AB][0-9A-F][89AB][0-9A-F]")
ORACLE = {"op6_suffix_shards": f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT rid, i, md5(substr(x, 2 * i + 1, {2 * LENGTH})) AS h FROM (SELECT rid, x, unnest(range(0, n - {LENGTH - 1})) AS i FROM d WHERE n >= {LENGTH})),
often AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
s AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap FROM w WHERE h IN (SELECT h FROM often)),
g AS (SELECT rid, i, sum(CASE WHEN gap IS NULL OR gap > {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run FROM s),
runs AS (SELECT rid, run, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY rid, run),
before AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS e FROM runs),
cut AS (
  SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS head
  FROM before JOIN d USING (rid) GROUP BY rid),
kept AS (SELECT d.*, n_removed, n_spans, CASE WHEN last IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END AS y FROM d LEFT JOIN cut USING (rid))
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(y)) AS kept_sha256,
  decode(unhex(array_to_string(list_filter(regexp_extract_all(y, '{_CHARACTER}|[0-9A-F][0-9A-F]'),
    lambda c: len(c) > 2 OR c < '80'), ''))) AS text
FROM kept"""}
