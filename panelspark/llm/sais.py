"""Suffix arrays of many shards at once, by induced sorting in lockstep.

All shards of a batch are columns of one matrix, position by position, so a
step of the linear scan that induces one shard's array does it for all.
The parts are the usual ones: suffixes are classified as smaller (S) or larger (L)
than their successor; leftmost smaller (LMS) substrings are sorted by one round of
induction and named; where names repeat, the shorter strings of names are
sorted recursively; the sorted LMS suffixes induce the whole array.

``lcp_permuted`` computes common prefixes with the preceding suffix in
text order (each is at least its left neighbour's less one), eight bytes at
a time, again for all shards at once.
"""

from __future__ import annotations

import numpy as np

from panelspark.llm.common import ship

ship(__name__)


def _types(t: np.ndarray, n: np.ndarray) -> np.ndarray:
    """True where a suffix is S-type; ``t``: (positions, shards)."""
    length, shards = t.shape
    pos = np.arange(length, dtype=np.int32)[:, None]
    differ = np.full((length, shards), length - 1, np.int32)
    differ[:-1] = np.where(t[:-1] != t[1:], pos[:-1], length - 1)
    differ = np.minimum.accumulate(differ[::-1], axis=0)[::-1]
    nxt = np.minimum(differ + 1, length - 1)
    cols = np.arange(shards)
    s = t[differ, cols] < t[nxt, cols]
    s[n - 1, cols] = True
    return s


def _bucket_ends(t: np.ndarray, inside: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last slot of every (symbol, shard) bucket, flat."""
    shards = t.shape[1]
    flat = (t.astype(np.int64) * shards + np.arange(shards))[inside]
    count = np.bincount(flat, minlength=k * shards).reshape(k, shards)
    end = np.cumsum(count, axis=0)
    return end - count, end


def _induce(t, s_type, inside, k, lms_sorted, lms_shard):
    """Suffix array from LMS suffixes in sorted order (flat positions, with
    each shard's together); flat positions by (slot, shard), -1: none."""
    length, shards = t.shape
    cells = length * shards
    start, end = _bucket_ends(t, inside, k)
    sa = np.full(cells + 1, cells, np.int32)
    bucket = (t.astype(np.int64) * shards + np.arange(shards)).astype(np.int32)
    # what a suffix puts in: the bucket of the suffix before it, if of the type scanned for
    from_l = np.full(cells + 1, -1, np.int32)
    from_s = np.full(cells + 1, -1, np.int32)
    body = inside[1:] & inside[:-1]
    f = from_l[:cells].reshape(length, shards)
    f[1:] = np.where(body & ~s_type[:-1], bucket[:-1], -1)
    f = from_s[:cells].reshape(length, shards)
    f[1:] = np.where(body & s_type[:-1], bucket[:-1], -1)
    # LMS suffixes at the ends of their buckets
    b = bucket.ravel()[lms_sorted].astype(np.int64)
    of_bucket = np.bincount(b, minlength=k * shards).reshape(k, shards)
    after = np.cumsum(of_bucket, axis=0).ravel()
    first = np.searchsorted(lms_shard, np.arange(shards))
    nth = np.arange(len(lms_sorted)) - first[lms_shard]
    slot = end.ravel()[b] - (after[b] - nth)
    sa[slot * shards + lms_shard] = lms_sorted
    cols = np.arange(shards)
    head = (start * shards + cols).ravel().astype(np.int32)
    for p in range(0, cells, shards):
        row = sa[p:p + shards]
        code = from_l[row]
        sel = np.flatnonzero(code >= 0)
        if len(sel):
            c = code[sel]
            to = head[c]
            sa[to] = row[sel] - shards
            head[c] = to + shards
    tail = (end * shards + cols).ravel().astype(np.int32)
    for p in range(cells - shards, -1, -shards):
        row = sa[p:p + shards]
        code = from_s[row]
        sel = np.flatnonzero(code >= 0)
        if len(sel):
            c = code[sel]
            to = tail[c] - shards
            sa[to] = row[sel] - shards
            tail[c] = to
    return sa[:cells].reshape(length, shards)


def suffix_arrays(t: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """``t``: (positions, shards) symbols below ``k``; column ``b`` has ``n[b]``
    of them, the last a 0 that occurs nowhere else in it.  Returns
    flat positions (position * shards + shard) by (slot, shard)."""
    length, shards = t.shape
    inside = np.arange(length)[:, None] < n
    s_type = _types(t, n)
    lms = np.zeros_like(s_type)
    lms[1:] = s_type[1:] & ~s_type[:-1] & inside[1:]
    lms[0] = n == 1
    shard, pos = np.nonzero(lms.T)                       # by shard, in text order
    flat = (pos * shards + shard).astype(np.int32)
    symbol = t.ravel()[flat]
    order = np.lexsort((np.arange(len(flat)), symbol, shard))
    sa = _induce(t, s_type, inside, k, flat[order], shard[order])
    # LMS substrings in sorted order, named
    is_lms = np.append(lms.ravel(), False)
    mask = is_lms[sa] & inside
    by_sub = sa.T[mask.T]
    of = np.nonzero(mask.T)[0]
    until = np.ones(length * shards, np.int32)          # symbols to the next LMS position, inclusive
    same = shard[1:] == shard[:-1]
    until[flat[:-1]] = np.where(same, pos[1:] - pos[:-1] + 1, 1)
    new = np.ones(len(by_sub), bool)
    new[1:] = of[1:] != of[:-1]
    check = np.flatnonzero(~new)
    check = check[until[by_sub[check]] == until[by_sub[check - 1]]]
    equal = np.zeros(len(by_sub), bool)
    text = t.ravel()
    d = 0
    while len(check):
        ended = until[by_sub[check]] <= d
        equal[check[ended]] = True
        check = check[~ended]
        check = check[text[by_sub[check] + d * shards] == text[by_sub[check - 1] + d * shards]]
        d += 1
    first = np.searchsorted(of, np.arange(shards))
    step = (~equal).astype(np.int64)
    name = np.cumsum(step)
    name = (name - name[first][of]).astype(np.int32)
    count = np.bincount(of, minlength=shards)
    if equal.any():
        name_at = np.zeros(length * shards, np.int32)
        name_at[by_sub] = name
        m = int(count.max())
        short = np.zeros((m, shards), np.int32)
        nth = np.arange(len(flat)) - first[shard]
        short[nth, shard] = name_at[flat]
        below = suffix_arrays(short, count, int(name.max()) + 1)
        rows = np.arange(m)[:, None] < count
        sorted_nth = below.T[rows.T] // shards
        by_suffix = flat[first[of] + sorted_nth]
    else:
        by_suffix = by_sub
    return _induce(t, s_type, inside, k, by_suffix.astype(np.int32), of)


def lcp_permuted(raw: np.ndarray, n: np.ndarray, sa: np.ndarray, enough: int) -> np.ndarray:
    """Common prefix (at least ``enough`` where it is) of each suffix and the one
    before it in its shard's array, by (position, shard).

    ``raw``: (positions + 8, shards) bytes.
    """
    length, shards = sa.shape
    cols = np.arange(shards)
    word = np.zeros((length, shards), np.uint64)
    for j in range(8):
        word |= raw[j:length + j].astype(np.uint64) << np.uint64(8 * j)
    word = word.ravel()
    valid = np.arange(length)[:, None] < n
    before = np.full(length * shards, -1, np.int32)
    later = valid[1:]
    before[sa[1:][later]] = sa[:-1][later]
    before[sa[0]] = -1
    out = np.zeros(length * shards + 1, np.int32)
    at = cols.astype(np.int64)                           # flat position that each shard works on
    end = cols + (n - 1).astype(np.int64) * shards       # the sentinel's
    got = np.zeros(shards, np.int64)
    live = np.flatnonzero(at < end)
    at, end, got, stop = at[live], end[live], got[live], (length * shards)
    last = stop - shards + cols[live]
    while len(at):
        prev = before[at].astype(np.int64)
        a, b = at + got * shards, prev + got * shards
        over = np.maximum(a, b) >= stop
        diff = word[np.minimum(a, last)] ^ word[np.minimum(np.maximum(b, 0), last)]
        same = np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
        same[diff == 0] = 8
        same[over | (prev < 0)] = 0
        got += same
        done = (same < 8) | (got >= enough)
        fin = np.flatnonzero(done)
        out[at[fin]] = np.where(prev[fin] < 0, 0, got[fin])
        got[fin] = np.maximum(got[fin] - 1, 0)
        at[fin] += shards
        over_end = at[fin] >= end[fin]
        if over_end.any():
            keep = at < end
            at, end, got, last = at[keep], end[keep], got[keep], last[keep]
    return out[:-1].reshape(length, shards)
