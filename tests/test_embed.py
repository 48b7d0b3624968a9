"""Word2Vec (EMB-1) and the embedding matrix (EMB-3..5), vector text I/O."""
import numpy as np

from panelspark.operators import corpus as C
from panelspark.operators import embed as EM
from panelspark.sources import readers as R
from panelspark.sources import writers as W


def two_clusters(spark):
    a = [f"{i:06d}" for i in range(1, 9)]
    b = [f"{i:06d}" for i in range(101, 109)]
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        grp = a if k % 2 == 0 else b
        rows.append((k, ["[CLS]"] + list(rng.choice(grp, 5, replace=False)) + ["[SEP]"]))
    return spark.createDataFrame(rows, "rid int, tokens array<string>"), a, b


def test_word2vec_neighbours(spark):
    sent, a, b = two_clusters(spark)
    model, vec = EM.train_word2vec(sent, vector_size=16, window=5, min_count=1, max_iter=10, seed=42)
    v = {r.token: np.array(r.vector) for r in vec.collect()}
    assert len(v) == 18 and all(len(x) == 16 for x in v.values())

    def cos(x, y):
        return float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    inside = np.mean([cos(v[a[0]], v[t]) for t in a[1:]])
    across = np.mean([cos(v[a[0]], v[t]) for t in b])
    assert inside > across


def test_matrix_special_rows(spark):
    sent, a, b = two_clusters(spark)
    vocab = C.vocabulary(sent)
    vectors = spark.createDataFrame([(t, [float(i), float(i) * 2.0]) for i, t in
                                     enumerate(["[CLS]", "[SEP]"] + a + b)], "token string, vector array<double>")
    m = {r["index"]: np.array(r.vector) for r in EM.embedding_matrix(vocab, vectors, seed=1).collect()}
    n = 18
    assert sorted(m) == list(range(n + 5))
    np.testing.assert_allclose(m[n + 3], m[0])
    np.testing.assert_allclose(m[n + 4], m[1])
    np.testing.assert_allclose(m[n + 1], 0.0)
    body = np.stack([m[i] for i in range(n)] + [m[n + 3], m[n + 4]])
    np.testing.assert_allclose(m[n], body.sum(axis=0) / (n + 5))
    full = np.stack([m[i] if i != n + 2 else np.zeros(2) for i in range(n + 5)])
    z = (m[n + 2] - full.mean()) / full.std()
    assert np.all(np.abs(z) < 6)


def test_vector_text_roundtrip(spark, tmp_path):
    vec = spark.createDataFrame([("000001", [0.5, -1.25]), ("[CLS]", [2.0, 3.0])], "token string, vector array<float>")
    out = str(tmp_path / "vec.txt")
    W.write_w2v_text(vec, out)
    first = sorted(p for p in __import__("os").listdir(out) if p.startswith("part-"))[0]
    assert open(f"{out}/{first}").readline().strip() == "2 2"
    back = {r.token: list(r.vector) for r in R.read_w2v_text(spark, out).collect()}
    assert back == {"000001": [0.5, -1.25], "[CLS]": [2.0, 3.0]}
    assert EM.vector_of(R.read_w2v_text(spark, out), "000001").count() == 1


def test_vocab_json(spark, tmp_path):
    sent, _, _ = two_clusters(spark)
    out = str(tmp_path / "vocab")
    W.write_vocab_json(C.vocabulary(sent), out)
    rows = W.read_json_lines(out)
    assert len(rows) == 23 and {r["token"] for r in rows} >= {"[MASK]", "0[CLS]"}


def test_word2vec_fixed_seed_one_partition_is_repeatable(spark):
    sent, a, b = two_clusters(spark)
    runs = []
    for _ in range(2):
        _, vec = EM.train_word2vec(sent, vector_size=8, window=5, min_count=1, max_iter=2, seed=7, num_partitions=1)
        runs.append({r.token: list(r.vector) for r in vec.collect()})
    assert runs[0] == runs[1]
    assert len(runs[0]) == 18 and all(len(v) == 8 for v in runs[0].values())


def test_vocabulary_beyond_the_driver_budget_is_trained_in_blocks(spark):
    sent, a, b = two_clusters(spark)
    model, vec = EM.train_word2vec(sent, vector_size=16, window=5, min_count=1, max_iter=6, step_size=0.1, seed=42, driver_budget_mb=0)
    v = {r.token: np.array(r.vector) for r in vec.collect()}
    assert model is None and set(v) == {"[CLS]", "[SEP]", *a, *b}
    assert all(x.shape == (16,) and np.isfinite(x).all() for x in v.values())
    mean = np.mean([v[t] for t in a + b], axis=0)

    def cos(x, y):
        return float((x - mean) @ (y - mean) / np.linalg.norm(x - mean) / np.linalg.norm(y - mean))
    inside = np.mean([cos(v[x], v[y]) for g in (a, b) for x in g for y in g if x < y])
    assert inside > np.mean([cos(v[x], v[y]) for x in a for y in b])


def test_sentences_are_worked_out_once_for_training_in_blocks(spark, monkeypatch):
    from panelspark.operators import skipgram as SG
    sent, a, b = two_clusters(spark)
    names, real = [], SG.staged

    def noted(df, name, *more, **options):
        names.append(name)
        return real(df, name, *more, **options)
    monkeypatch.setattr(EM, "staged", noted)
    monkeypatch.setattr(SG, "staged", noted)
    _, vec = EM.train_word2vec(sent, vector_size=8, max_iter=1, driver_budget_mb=0)
    assert {r.token for r in vec.collect()} == {"[CLS]", "[SEP]", *a, *b}
    assert [x for x in names if "sentences" in x] == ["word2vec-sentences"]
