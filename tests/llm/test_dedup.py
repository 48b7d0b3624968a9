"""OP 4, 5 and 6 against brute force."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import cws, sais, simhash, suffix_dedup
from panelspark.llm.components import components
from tests.llm.helpers import components as plain_components
from tests.llm.helpers import edge_docs, fingerprint, long_text, repeats

SF = "/root/testdata/sf0.001"


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(500, 600)] + [(3, 3), (900, 901), (901, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 7 for k in [7, *range(500, 600)])
    assert got[901] == 900 and 3 not in got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    base = docs.filter("n_chars > 3000").first().text
    near = [(10_000 + i, base.replace(base.split()[40 + i], "changed", 1)) for i in range(40)]
    more = [(-1, ""), (-2, None), (-3, "a"), (-4, "A  b"), (-5, "a b c"), (-6, "É x"), (-7, "a b"), (-8, long_text())]
    df = docs.union(spark.createDataFrame(near + more, "doc_id long, text string"))
    rows = sorted((r.doc_id, fingerprint(r.text)) for r in df.collect())
    first = plain_components([f for _, f in rows])
    want = {d: (f"{f:016x}", rows[first[i]][0]) for i, (d, f) in enumerate(rows)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(df, per_node=32, hot=64).collect()}
    assert got == want


@pytest.mark.parametrize("per_node,hot", [(8192, 65536), (16, 40)])
def test_trie_join_of_dense_and_random_values(spark, per_node, hot):
    rng = np.random.default_rng(0)
    flips = sum(np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64) for _ in range(3))
    values = np.unique(np.concatenate([rng.integers(0, 2 ** 63, 300, dtype=np.uint64), np.uint64(12345 << 20) ^ flips]))
    leaves = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").checkpoint()
    got = {r.node: r.root for r in components(simhash.trie_self_join(leaves, 2, per_node, hot)).collect()}
    first = plain_components(values)
    signed = values.view(np.int64).tolist()
    groups, found = {}, {}
    for i, f in enumerate(first):
        groups.setdefault(f, set()).add(signed[i])
        found.setdefault(got.get(signed[i], signed[i]), set()).add(signed[i])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_keep_one_keeps_the_smallest_id(spark):
    df = edge_docs(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    rows = kept.select("doc_id", "text").collect()
    whole = {(r.doc_id, r.component_id) for r in simhash.simhash_groups(df).collect()}
    assert len(rows) == len({fingerprint(t) for t in [r.text for r in df.collect()]}) and len(whole) <= df.count()
    assert [r.doc_id for r in rows if r.text == "x"] == [5]
    assert simhash.simhash_groups(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def columns(strs):
    n = np.array([len(s) + 1 for s in strs])
    t = np.zeros((n.max(), len(strs)), np.int32)
    raw = np.full((n.max() + 8, len(strs)), 254, np.uint8)
    for b, s in enumerate(strs):
        a = np.frombuffer(s, np.uint8)
        t[:len(a), b] = a.astype(np.int32) + 1
        raw[:len(a), b] = a
    return t, raw, n


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(40):
        strs = [bytes(rng.integers(97, 97 + rng.integers(1, 5), rng.integers(0, 60)).astype(np.uint8)) for _ in range(rng.integers(1, 8))]
        if trial % 3 == 0:
            strs = [s * 3 for s in strs]
        t, raw, n = columns(strs)
        sa = sais.suffix_arrays(t, n, 257)
        lcp = sais.lcp_permuted(raw, n, sa, 10 ** 9)
        for b, s in enumerate(strs):
            x = s + b"\0"
            want = sorted(range(len(x)), key=lambda i: x[i:])
            assert (sa[:n[b], b] // len(strs)).tolist() == want
            for p, q in zip(want, want[1:]):
                k = 0
                while max(p, q) + k < len(s) and s[p + k] == s[q + k]:
                    k += 1
                assert lcp[q, b] == k


@pytest.mark.parametrize("length,gram,group", [(24, 8, 24), (24, 8, 2), (40, 16, 24)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, gram, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = np.random.default_rng(3)
    letters = ["a", "b", " é"]
    passages = ["".join(rng.choice(letters, 60)) for _ in range(5)]
    texts = []
    for _ in range(150):
        texts.append("".join(passages[rng.integers(5)][rng.integers(0, 20):] if rng.random() < .5 else "".join(rng.choice(letters, rng.integers(0, 50)))
                             for _ in range(rng.integers(0, 6))))
    texts += [None, "", "x" * 900, "ab" * 300, texts[3], texts[3], long_text(2000) + texts[5]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.remove_repeats(df, keep=["doc_id"], length=length, gram=gram).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, length)


def test_repeats_of_the_table_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    df = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, keep=["doc_id"]).collect()}
    assert [got[r.doc_id] for r in docs] == repeats([r.text for r in docs], 400)
    edge = edge_docs(spark)
    assert suffix_dedup.remove_repeats(edge, keep=edge.columns).count() == edge.count()
    assert suffix_dedup.remove_repeats(edge.limit(0), keep=["doc_id"]).count() == 0
    assert suffix_dedup.strip_repeats(edge).columns == edge.columns
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(edge, gram=48)


def jaccard(a, b):
    a, b = Counter((a or "").split()), Counter((b or "").split())
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_weighted_samples(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = cws.op4_weighted_samples(spark, SF).collect()
    ids = sorted(docs, reverse=True)
    after = {a: ids[(i + 1) % len(ids)] for i, a in enumerate(ids)}
    off, prints = [], {}
    assert sorted(r.doc_id for r in got) == sorted(ids)
    for r in got:
        text, nxt = docs[r.doc_id], docs[after[r.doc_id]]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        off += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, nxt)]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.09


def test_weighted_samples_estimate_weights(spark):
    """Same words, other counts: the likeness is that of the weights."""
    a, b = "x " * 9 + "y " * 3 + "z", "x " * 3 + "y " * 9 + "z"
    texts = spark.createDataFrame([(0, a), (1, b)], "k int, t string")
    sig = {r.k: r.sig_ for r in cws.signatures(texts, ["k"], "t", 200).collect()}
    same = np.mean([p == q for p, q in zip(sig[0], sig[1])])
    assert abs(same - jaccard(a, b)) < 0.12


def test_weighted_samples_of_edges(spark):
    df = edge_docs(spark)
    got = cws.fingerprint_pairs(df, samples=8).collect()
    assert len(got) == df.count()
    assert all(r.fingerprint == "0" * 64 for r in got if r.n_chars == 0)
    assert cws.fingerprint_pairs(df.limit(0), samples=8).count() == 0
    one = cws.fingerprint_pairs(df.filter("doc_id = 8"), samples=8).first()
    assert one.near_next == 1.0
    assert cws.fingerprint_pairs(df.filter("doc_id is null"), samples=8).count() == 2


def test_shard_arrays_hold_no_more_than_the_windows():
    import tracemalloc
    rng = np.random.default_rng(5)
    core = rng.integers(97, 123, 500, dtype=np.uint8).tobytes()
    shard = [rng.integers(97, 123, 60, dtype=np.uint8).tobytes() + core[:450 + k] + b"~" * k for k in range(20)] + [b"a" * 900, core * 2]
    rows = {"low": [], "part": [], "split": [], "n_occ": [], "k1": [], "k2": [], "start": [], "count": [], "content": []}
    for g in range(60):
        for k, x in enumerate(shard):
            for c, v in zip(rows, (g, 0, False, 1, 100 * g + k, 0, 0, len(x) - 399, x)):
                rows[c].append(v)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict(rows)
    tracemalloc.start()
    found = [r for b in suffix_dedup.shard_task(400)([batch]) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = Counter(x[i:i + 400] for x in shard for i in range(len(x) - 399))
    want = {(k, i + j) for k, x in enumerate(shard) for i in range(len(x) - 399) if seen[x[i:i + 400]] > 1 for j in range(400)}
    assert all({(r["k1"] - 100 * g, j) for r in found if r["k1"] // 100 == g for j in range(r["a"], r["b"])} == want for g in range(60))
    assert peak < 48 << 20
