"""OP 11 against brute force."""
import numpy as np
import pytest

from panelspark.llm import flat_graph as FG

SCHEMA = "vec_id long, embedding array<float>, label int, node string, uid string, x string, k1 string"


def plain(rows, cosine=0.9):
    """Sorted (id, links, component, kept) by all pairs."""
    length = {}
    for _, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            length[len(v)] = length.get(len(v), 0) + 1
    dim = max(length, key=lambda k: (length[k], k)) if length else 0
    use = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) == dim and dim and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    u = np.array([rows[k][1] for k in use], np.float32).astype(np.float64).reshape(len(use), dim)
    u /= np.abs(u).max(axis=1, keepdims=True) if len(u) else 1
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True)) if len(u) else 1
    near = u @ u.T >= cosine
    up = list(range(len(use)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in zip(*np.nonzero(near)):
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    root = [find(i) for i in range(len(use))]
    best = {}
    for i, r in enumerate(root):
        if rows[use[i]][0] is not None:
            best[r] = min(best.get(r, rows[use[i]][0]), rows[use[i]][0])
    out = [(i, 0, i, True) for i, _ in rows]
    for i, k in enumerate(use):
        c = best.get(root[i])
        out[k] = (rows[k][0], int(near[i].sum()) - 1, c, rows[k][0] == c)
    return sorted(out, key=str)


def grouped(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, "clash", "clash", "clash", "clash") for i, v in rows], SCHEMA)
    return sorted(map(tuple, FG.near_groups(df, **more).collect()), key=str)


def planted(seed, n, groups, spread, dim=32):
    """Random vectors and groups of near ones, in mixed order."""
    rng = np.random.default_rng(seed)
    v = [rng.standard_normal(dim) for _ in range(n)]
    for size in groups:
        base = rng.standard_normal(dim)
        v += [base + rng.standard_normal(dim) * spread * rng.random() for _ in range(size)]
    order = rng.permutation(len(v))
    return [(int(k), (v[j] * rng.uniform(0.1, 9)).tolist()) for k, j in enumerate(order)]


def test_equals_brute_force(spark):
    rows = planted(1, 800, [2, 2, 3, 5, 9, 30, 120], 0.5)
    rows += [(5000 + k, rows[7][1]) for k in range(40)] + [(6000, [2 * x for x in rows[9][1]])]
    assert grouped(spark, rows) == plain(rows)


@pytest.mark.parametrize("spread", [0.25, 0.9])
def test_small_shards_and_a_hot_group(spark, monkeypatch, spread):
    for name, value in (("SHARD_ROWS", 100), ("SHARD_MAX", 200), ("FIT_ROWS", 300), ("FAN", 4), ("MEMBERS", 64), ("AUDIT", 2000)):
        monkeypatch.setattr(FG, name, value)
    rows = planted(2, 1200, [2, 2, 2, 4, 4, 8, 16, 700], spread)
    got, want = grouped(spark, rows), plain(rows)
    true, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert all(a[1] <= b[1] for a, b in zip(got, want)) and found >= 0.95 * true
    if spread == 0.25:
        assert got == want


def test_the_graph_search_finds_what_is_in_range():
    u = np.array([v for _, v in planted(4, 900, [2] * 60 + [6] * 10, 0.4)], np.float64)
    u = (u / np.linalg.norm(u, axis=1, keepdims=True)).astype(np.float32)
    adj = np.full((len(u), FG.DEGREE), -1)
    fill = np.zeros(len(u), int)
    for i, j, _ in FG.robust_prune(u):
        adj[i, fill[i]] = j
        fill[i] += 1
    assert fill.max() <= FG.DEGREE and fill.min() >= 1
    q, x, _ = FG.range_search(u, np.zeros(len(u), np.float32), adj, np.arccos(0.9))
    true = {(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.9)) if a != b}
    both = set(zip(q.tolist(), x.tolist()))
    both |= {(b, a) for a, b in both}
    assert len(true & both) >= 0.98 * len(true) > 100
    seen = FG.greedy(u, adj, 0, FG.BEAM)
    assert seen.sum() < 0.7 * len(u) ** 2                       # a search does not visit all rows


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [3.0, 0.1]), (3, None), (4, [0.0, 0.0]), (4, [-0.0, 0.0]), (5, [1.0, None]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0]), (10, [0.0, 1.0]), (-1, [0.0, 5.0]), (11, [-1.0, -0.0]), (12, [-1.0, 0.0]),
            (None, [-1.0, 1.0])]
    assert grouped(spark, rows) == plain(rows)
    assert grouped(spark, []) == [] and grouped(spark, [(3, None), (None, None)]) == plain([(3, None), (None, None)])
    assert grouped(spark, [(3, [1.0, 2.0])]) == [(3, 0, 3, True)]
