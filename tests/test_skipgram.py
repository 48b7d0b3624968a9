"""Skip-gram with negative sampling over vocabulary blocks (EMB-1)."""
import numpy as np
import pyarrow as pa
import pytest

from panelspark.operators import skipgram as SG


def clusters(spark, per=8, rows=400):
    a = [f"{i:06d}" for i in range(1, 1 + per)]
    b = [f"{i:06d}" for i in range(101, 101 + per)]
    rng = np.random.default_rng(0)
    out = [(["[CLS]"] + list(rng.choice(a if k % 2 else b, 5, replace=False)) + ["[SEP]"],) for k in range(rows)]
    return spark.createDataFrame(out, "tokens array<string>"), a, b


def vectors(df):
    return {r.token: np.array(r.vector) for r in df.collect()}


def cos(x, y):
    return float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))


@pytest.mark.parametrize("more", [{}, {"block_rows": 9, "pairs_per_task": 1500}])
def test_clusters_separate(spark, more):
    sent, a, b = clusters(spark)
    v = vectors(SG.train_skipgram(sent, vector_size=16, epochs=6, alpha=0.1, **more))
    assert len(v) == 18 and all(x.shape == (16,) and np.isfinite(x).all() for x in v.values())
    mean = np.mean([v[x] for x in a + b], axis=0)               # what all tokens share says nothing about clusters
    v = {k: x - mean for k, x in v.items()}
    inside = np.mean([cos(v[x], v[y]) for g in (a, b) for x in g for y in g if x < y])
    across = np.mean([cos(v[x], v[y]) for x in a for y in b])
    assert inside > across + 0.2


def test_equal_for_any_partitioning(spark):
    sent, _, _ = clusters(spark, rows=120)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    try:
        for n in (2, 8):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            runs.append(vectors(SG.train_skipgram(sent.repartition(n), vector_size=8, epochs=2, block_rows=6, pairs_per_task=100, seed=7)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert runs[0].keys() == runs[1].keys()
    assert all((runs[0][k] == runs[1][k]).all() for k in runs[0])
    other = vectors(SG.train_skipgram(sent, vector_size=8, epochs=2, block_rows=6, pairs_per_task=100, seed=8))
    assert any((other[k] != runs[0][k]).any() for k in other)


def test_pairs_are_those_of_the_window(spark):
    rows = [(["a", "b", "c", "d", "e"],), (["x"],), ([],), (None,), (["p", None, "p"],)]
    got = sorted((r.centre, r.context, r.dist) for r in SG.window_pairs(spark.createDataFrame(rows, "tokens array<string>"), "tokens", 2).collect()
                 if r.centre is not None and r.context is not None)
    want = sorted((t[i], t[j], abs(i - j)) for (t,) in rows if t for i in range(len(t)) for j in range(len(t))
                  if i != j and abs(i - j) <= 2 and t[i] and t[j])
    assert got == want


def test_alias_table_has_the_weights():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        w = rng.random(n) ** 4 + 1e-6
        cut, alias = SG.alias_table(w)
        p = np.zeros(n)
        np.add.at(p, np.arange(n), cut / n)
        np.add.at(p, alias, (1 - cut) / n)
        assert np.allclose(p, w / w.sum(), atol=1e-5)


def test_one_step_follows_the_gradient():
    rng = np.random.default_rng(2)
    u, v = rng.standard_normal((3, 4)).astype(np.float32), rng.standard_normal((1, 4)).astype(np.float32)
    before, w = u.copy(), v.copy()
    SG.train_cell(np.array([1]), np.array([0]), u, v, np.ones(1, np.float32), np.zeros(1, np.int64), (0.1, 0.1), 2, rng)
    pull = 0.1 / (1 + np.exp(before[1] @ w[0]))           # the only negatives are the context itself, so they don't count
    assert np.allclose(u[1], before[1] + pull * w[0], atol=1e-6) and np.allclose(v[0], w[0] + pull * before[1], atol=1e-6)
    assert (u[[0, 2]] == before[[0, 2]]).all()


def test_min_count_and_nothing(spark):
    sent = spark.createDataFrame([(["a", "b", "a", "rare"],)], "tokens array<string>")
    assert set(vectors(SG.train_skipgram(sent, vector_size=4, epochs=1, min_count=2))) == {"a"}
    assert SG.train_skipgram(sent.limit(0), vector_size=4).count() == 0


def test_cells_trained_side_by_side_are_not_sliced(spark, monkeypatch):
    sent, _, _ = clusters(spark, rows=120)
    monkeypatch.setattr(SG, "_average", lambda dim: pytest.fail("a cell of a few times pairs_per_task was cut"))
    v = vectors(SG.train_skipgram(sent, vector_size=8, epochs=1, block_rows=6, pairs_per_task=400))
    assert len(v) == 18


def test_rows_are_added_as_often_as_used():
    rng = np.random.default_rng(4)
    table, rows = rng.random((40, 6)).astype(np.float32), np.concatenate([rng.integers(0, 40, 60), np.full(200, 7)])
    change, uses = rng.random((260, 6)).astype(np.float32), np.where(rows == 7, 2.0, 1.0)
    want = table.astype(np.float64)
    for r, c in zip(rows, change):
        want[r] += c * min(1.0, SG.ROW_STEPS / max(1.0, uses[rows == r].sum()))
    SG._add_rows(table, rows, change, uses)
    assert np.allclose(table, want, rtol=1e-4)


def test_steps_hand_packed_blocks_on(spark, monkeypatch):
    """Sentences are worked out once, a table has a row per ``PART`` vectors or piece of a cell, and one job runs ``CHAIN`` steps."""
    sent, _, _ = clusters(spark, rows=60)
    names, rows, real = [], [], SG.staged

    def noted(df, name, *more, **options):
        out = real(df, name, *more, **options)
        names.append(name)
        rows.append(out.count())
        return out
    monkeypatch.setattr(SG, "staged", noted)
    v = vectors(SG.train_skipgram(sent, vector_size=8, epochs=2, block_rows=2))
    assert len(v) == 18 and names.count("skipgram-sentences") == 1
    models = [n for x, n in zip(names, rows) if x == "skipgram-model"]
    assert models == [2 * 8] * (1 + 2 * (8 // SG.CHAIN))       # 9 blocks of 2 rows become 8
    assert rows[names.index("skipgram-pairs")] <= 8 * 8


def test_a_pass_draws_near_pairs_oftener():
    dist = np.repeat(np.arange(1, 6, dtype=np.uint8), 4_000)
    a, b = np.arange(len(dist), dtype=np.int32), -np.arange(len(dist), dtype=np.int32)
    column = pa.array([a.tobytes() + b.tobytes() + dist.tobytes()], pa.binary())
    draws = [SG._drawn(column, [0], 5, np.random.default_rng(k)) for k in (0, 0, 1)]
    assert (draws[0][0] == draws[1][0]).all() and len(draws[0][0]) != len(draws[2][0])
    x, y = draws[0]
    assert (x == -y).all() and len(np.unique(x)) == len(x) and (np.diff(x) < 0).any()
    assert np.allclose(np.bincount(dist[x], minlength=6)[1:] / 4_000, [1, 0.8, 0.6, 0.4, 0.2], atol=0.03)


def test_rows_used_once_and_oftener_change_as_by_add_rows():
    rng = np.random.default_rng(5)
    for rows in (rng.permutation(40)[:30], rng.integers(0, 40, 60), np.concatenate([rng.permutation(30), np.full(200, 35)])):
        table, change = rng.random((40, 6)).astype(np.float32), rng.random((len(rows), 6)).astype(np.float32)
        uses = np.where(rows == 35, 2.0, 1.0)
        want = table.copy()
        SG._add_rows(want, rows, change, uses)
        SG._apply(table, table.view(np.dtype((np.void, 24))).ravel(), rows, table[rows], change, uses, np.zeros(40, np.int32), np.arange(len(rows), dtype=np.int32))
        assert np.allclose(table, want, rtol=1e-5)
