"""Deterministic, partition-independent randomness.

A uniform draw is the first 8 hex digits of ``md5("seed:stream:key:pos")``
divided by 2**32.  It depends only on the row's own key, never on
partitioning or task retries, and DuckDB computes the same number with
``('0x' || substr(md5(s), 1, 8))::BIGINT / 4294967296``, so seeded operators
(masking, subsampling, shuffling) still have a SQL oracle.  ``rand()`` is
never used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_key(seed: int, stream: str, *parts: Column | str) -> Column:
    cols = [F.lit(str(seed)), F.lit(stream)] + [
        (F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat_ws(":", *cols)


def digest(seed: int, stream: str, *parts: Column | str) -> Column:
    """32 hex digits: four independent 32-bit draws from one md5."""
    return F.md5(hash_key(seed, stream, *parts))


def uniform_at(h: Column, k: int = 0) -> Column:
    """The ``k``-th (0..3) U[0, 1) draw of a digest."""
    if not 0 <= k <= 3:
        raise ValueError("a digest holds four draws")
    return F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_32)


def uniform(seed: int, stream: str, *parts: Column | str) -> Column:
    """U[0, 1) from the key ``seed:stream:parts...``."""
    return uniform_at(digest(seed, stream, *parts), 0)


def uniform_sql(seed: int, stream: str, *parts_sql: str, k: int = 0) -> str:
    """The same draw as DuckDB SQL text (for oracles)."""
    key = " || ':' || ".join([f"'{seed}'", f"'{stream}'"] + [f"CAST({p} AS VARCHAR)" for p in parts_sql])
    return f"(CAST(('0x' || substr(md5({key}), {1 + 8 * k}, 8)) AS BIGINT) / 4294967296.0)"


FEISTEL_ROUNDS = 4
FEISTEL_STEPS = 64


def feistel(index: Column, n: int, seed: int, stream: str = "feistel") -> Column:
    """A keyed permutation of 0..n-1: ``index`` -> its new place.

    Numbers below ``a * a`` (``a`` the rounded-up root of ``n``) are pairs of two
    digits; each round adds a hash of one digit to the other, modulo ``a``.
    Places from ``n`` on are walked on from until one below ``n`` is met; at
    most ``2 a`` numbers lie there, so a walk beyond ``FEISTEL_STEPS`` (which
    raises) does not occur: for small ``n`` there are fewer, for large ones its chance is below 1e-70."""
    a = math.isqrt(max(0, n - 1)) + 1

    def rounds(x: Column) -> Column:       # one round per element: a nested expression would repeat its hash
        pair = F.struct(F.floor(x / F.lit(a)).cast("long").alias("l"), F.pmod(x, F.lit(a)).cast("long").alias("r"))

        def step(acc, r):
            h = F.conv(F.substring(digest(seed, stream, r, acc["r"]), 1, 8), 16, 10).cast("long")
            return F.struct(acc["r"].alias("l"), F.pmod(acc["l"] + h, F.lit(a)).alias("r"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), pair, step, lambda p: p["l"] * F.lit(a) + p["r"])

    walk = min(a * a - n, FEISTEL_STEPS)
    out = rounds(index.cast("long"))
    if walk <= 0:
        return out
    out = F.aggregate(F.sequence(F.lit(1), F.lit(walk)), out, lambda x, _: F.when(x < n, x).otherwise(rounds(x)))
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("a walk of the permutation did not end")).cast("long"))


def feistel_sql(index: str, n: str, seed: int, stream: str = "feistel") -> str:
    """The same permutation as DuckDB SQL text; ``n`` is an expression, constant over the rows."""
    a = f"CAST(ceil(sqrt({n})) AS BIGINT)"

    def rounds(x: str) -> str:
        h = f"CAST('0x' || substr(md5('{seed}:{stream}:' || r || ':' || (p % {a})), 1, 8) AS BIGINT)"
        return f"list_reduce(list_prepend(CAST({x} AS BIGINT), range({FEISTEL_ROUNDS})), lambda p, r: (p % {a}) * {a} + ((p // {a} + {h}) % {a}))"

    return (f"list_reduce(list_prepend({rounds(index)}, range({FEISTEL_STEPS})), lambda q, k: CASE WHEN q < {n} THEN q ELSE {rounds('q')} END)")


def normal(seed: int, stream: str, *parts: Column | str, mean: Column | float = 0.0,
           std: Column | float = 1.0) -> Column:
    """N(mean, std) by Box-Muller from two uniform streams."""
    u1 = uniform(seed, stream + "/a", *parts)
    u2 = uniform(seed, stream + "/b", *parts)
    # 1 - u1 lies in (0, 1], so the log is finite
    z = F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(2.0 * math.pi * u2)
    return F.lit(mean) + F.lit(std) * z if not isinstance(mean, Column) else mean + std * z
