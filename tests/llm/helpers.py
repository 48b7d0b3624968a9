"""Small fixtures and brute-force versions."""
import hashlib
import re
from collections import Counter

import numpy as np

DOC = "doc_id long, text string"
EDGE = [(None, None), (None, "a b"), (5, "x"), (5, "x"), (5, "y z"), (6, ""), (7, " \n\t"), (8, "Ünïcode 日本語 don't 42!")]


def edge_docs(spark):
    """Nulls, empty texts, repeated rows and ids, and columns of clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, DOC)
    for c in ("fingerprint", "shard", "slot", "start", "n_tokens", "score", "ids", "k1", "rank", "uid", "family", "row_", "text_", "id_"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def long_text(n=30_000):
    return " ".join(f"word{i * 7919 % 5000}" for i in range(n))


def fingerprint(text, size=3):
    import xxhash
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    sh = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    bits = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(64):
            bits[k] += (h >> k) & 1
    return sum(1 << k for k in range(64) if bits[k] * 2 > len(sh))


def components(values, budget=2):
    """Index of the first member of each value's component."""
    v = np.array(values, np.uint64)
    up = list(range(len(v)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= budget):
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, SHA-256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def stripped(texts, length, words):
    """Each text without bytes of repeated strings of ``length`` bytes or of repeated
    passages of ``words`` words (from a first to a last word); cut characters go too."""
    raw = [(t or "").encode() for t in texts]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)] for b in raw]
    lists = [[b[x:y] for x, y in s] for b, s in zip(raw, spans)]
    strings = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    passages = Counter(tuple(w[i:i + words]) for w in lists for i in range(len(w) - words + 1))
    out = []
    for b, s, w in zip(raw, spans, lists):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if strings[b[i:i + length]] > 1:
                gone[i:i + length] = True
        for i in range(len(w) - words + 1):
            if passages[tuple(w[i:i + words])] > 1:
                gone[s[i][0]:s[i + words - 1][1]] = True
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out
