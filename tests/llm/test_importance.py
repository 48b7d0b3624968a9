"""OP 12 against a plain version."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from panelspark.llm import importance as IMP
from tests.llm.helpers import edge_docs, long_text

SF = "/root/testdata/sf0.001"
PLAIN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, order):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = PLAIN.findall(raw)
    return len(w), [b" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, order=1, buckets=10_000, percent=10, least=20):
    """(id, n_features, weight, score) of each row and the ids drawn, best first."""
    found = [(i, *features(t, order)) for i, t in docs]
    s = Counter(zlib.crc32(g) % buckets for _, _, f in found for g in f)
    t = Counter(zlib.crc32(g) % buckets for x in target for g in features(x, order)[1])
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * all_s / ((s[k] + 1) * all_t))) for k in s}
    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[zlib.crc32(g) % buckets] for g in f)
        rows.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = [r[0] for r in able[:percent * len(able) // 100]]
    return [(i, n, w, x) for i, _, n, w, x in rows], drawn


def result(df):
    rows = df.collect()
    got = [(r.doc_id, r.n_features, r.weight, r.score) for r in rows]
    drawn = sorted((r["rank"], r.doc_id) for r in rows if r["rank"] is not None)
    assert [k for k, _ in drawn] == list(range(1, len(drawn) + 1))
    return got, [d for _, d in drawn]


def order_of(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("order,percent", [(1, 10), (3, 35)])
def test_resample_equals_the_plain_version(spark, order, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, long_text()), (-4, "Ünï 日本語 " * 30), (-4, "Ünï 日本語 " * 30)], docs.schema))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got, drawn = result(IMP.resample(docs, bench, keep=["doc_id"], order=order, percent=percent))
    want, want_drawn = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()], order, percent=percent)
    assert order_of(got) == order_of(want) and drawn == want_drawn


def test_edges(spark):
    df = edge_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    out = IMP.resample(df, none, percent=50, min_words=1)
    assert set(df.columns) - {"score", "rank"} <= set(out.columns) and {"score_in", "rank_in"} <= set(out.columns)
    got, drawn = result(out)
    want, want_drawn = plain([(r.doc_id, r.text) for r in df.collect()], [], percent=50, least=1)
    assert order_of(got) == order_of(want) and drawn == want_drawn
    assert IMP.resample(df.limit(0), none).count() == 0


def test_table_tells_colliding_keys_apart_by_their_bytes():
    words = [f"w{i % 700}" for i in range(5000)] + ["", "x" * 40, "y" * 40, "x" * 40]
    raw = [w.encode() for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(r) for r in raw])
    start = np.cumsum(size) - size
    for hashes in (IMP.xxh64_spans, lambda b, s, n: (s % 3).astype(np.uint64) * np.uint64(0)):
        table = IMP.GramTable(buf, start, size, 97, hashes)
        assert [int(b) for b in table.bucket[table.slot]] == [zlib.crc32(r) % 97 for r in raw]
        counts = Counter(raw)
        assert [int(c) for c in table.count[table.slot]] == [counts[r] for r in raw]
        assert len(table.bucket) == len(counts)


def test_hash_equals_the_library():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 4000, dtype=np.uint8)
    size = np.arange(0, 60)
    start = rng.integers(0, 3900, 60)
    got = IMP.xxh64_spans(buf, start, size).tolist()
    assert got == [xxhash.xxh64_intdigest(buf[a:a + n].tobytes()) for a, n in zip(start.tolist(), size.tolist())]


def test_words_do_not_join_across_texts():
    buf, doc, start, size = IMP.word_spans(pa.array(["ab", None, "cd-EF", "", "9é"]))
    assert [(int(d), buf[a:a + n].tobytes().decode()) for d, a, n in zip(doc, start, size)] == [(0, "ab"), (2, "cd"), (2, "ef"), (4, "9é")]
