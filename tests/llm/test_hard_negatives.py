"""OP 13 against a plain version."""
import numpy as np
import pytest

from panelspark.llm import hard_negatives as HN

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, uid string"


def plain(rows, every=100, positives=5, negatives=5):
    """Sorted result rows; rows: (id, vector, label)."""
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (i, v, label) in enumerate(use):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, b, k) for b, (j, w, k) in enumerate(use) if b != a and len(w) == len(v)]
        near = sorted(s for s in scored if s[3] == label)[:positives]
        for p, j, _, _ in near:
            found = sorted(s for s in scored if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:negatives]
            out += [(i, j, r + 1, n[1], -p, -n[0]) for r, n in enumerate(found)]
    return sorted(out)


def mined(spark, rows, **more):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, HN.mine(df, label=label, **more).collect()))


@pytest.mark.parametrize("dim,scale", [(64, 0.12), (5, 1.0), (17, 900.0)])
def test_equals_the_plain_version(spark, dim, scale):
    rng = np.random.default_rng(dim)
    rows = [(i, (rng.standard_normal(dim) * scale).tolist(), int(rng.integers(0, 3))) for i in range(700)]
    assert mined(spark, rows) == plain(rows) != []


def test_blocks_parts_and_steps_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(16) * 0.2).tolist(), int(rng.integers(0, 2))) for i in range(500)]
    want = mined(spark, rows, anchor_every=10)
    monkeypatch.setattr(HN, "ANCHORS", 7)
    monkeypatch.setattr(HN, "ROWS", 60)
    assert mined(spark, rows, anchor_every=10) == want == plain(rows, every=10)


def test_ties_copies_and_a_hot_label(spark):
    rng = np.random.default_rng(4)
    hot = (rng.standard_normal(8) * 0.4).tolist()
    rows = [(i, hot, 1 if i % 3 else 2) for i in range(400)] + [(i, (rng.standard_normal(8) * 0.4).tolist(), i % 4) for i in range(400, 900)]
    assert mined(spark, rows) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [0.5, 0.5], 1), (1, [0.9, 0.0], 1), (2, [0.95, 0.0], 2), (3, [0.5, 0.4], 2), (3, [0.5, 0.4], 2),
            (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, [1.0, 0.0], None), (10, [], 2), (200, [], 1), (201, [], 1),
            (11, [1.0], 2), (300, [-1.0, -1.0], 1), (None, [1.0, 0.0], 2), (-100, [1.0, 0.1], 1), (-7, [0.3, 0.3], 9)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == [] == mined(spark, [(4, None, 1)])
    assert mined(spark, [(0, [1e9], 1), (1, [1e9], 1), (2, [1e9], 2)]) == []        # beyond the stated limit


def test_lookups_give_the_inner_product():
    rng = np.random.default_rng(5)
    for dim, largest in ((1, 1), (8, 255), (13, 256), (64, 1 << 20), (16, 0)):
        a, c = rng.integers(-largest, largest + 1, (9, dim)), rng.integers(-largest, largest + 1, (31, dim))
        got = HN.scores(HN.subset_sums(a, HN.score_type(largest, dim)), HN.pack_planes(c, HN.planes_needed(largest)))
        assert (got == c @ a.T).all()
