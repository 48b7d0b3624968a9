"""Registered token (TOK), masked-row (MLM) and embedding (EMB) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.rand import feistel_sql, uniform_sql
from panelspark.operators import corpus as C
from panelspark.operators import embed as EM
from panelspark.operators import mlm as M
from panelspark.operators import skipgram as SG
from panelspark.operators.scratch import staged
from panelspark.plans import views as V
from panelspark.plans.q_holdings import V_HOLD_SQL

KEYS = ["holder", "end_date"]
SEED = 42


def _pad_sql(x):
    return f"CASE WHEN length({x}) >= 6 THEN {x} ELSE lpad({x}, 6, '0') END"


# tokens of V_SENT, long form: (holder, end_date, pos, token), pos 0 = [CLS]
T_SQL = f"""WITH h AS ({V_HOLD_SQL}),
b AS (SELECT holder, end_date, symbol,
             row_number() OVER (PARTITION BY holder, end_date ORDER BY shares DESC, symbol) AS pos,
             count(*) OVER (PARTITION BY holder, end_date) AS n FROM h)
SELECT holder, end_date, pos, {_pad_sql('symbol')} AS token FROM b WHERE n >= 3
UNION ALL SELECT DISTINCT holder, end_date, 0, '[CLS]' FROM b WHERE n >= 3
UNION ALL SELECT DISTINCT holder, end_date, n + 1, '[SEP]' FROM b WHERE n >= 3"""

VOCAB_SQL = f"""WITH t AS ({T_SQL}),
c AS (SELECT token AS raw, count(*) AS cnt FROM t GROUP BY token),
v AS (SELECT {_pad_sql('raw')} AS token, raw, cnt,
             row_number() OVER (ORDER BY cnt DESC, {_pad_sql('raw')}, raw) - 1 AS idx FROM c),
n AS (SELECT count(*) AS nv FROM v)
SELECT token, raw, idx, cnt FROM v
UNION ALL SELECT '[MASK]', NULL, (SELECT nv FROM n), NULL
UNION ALL SELECT '[PAD]', NULL, (SELECT nv FROM n) + 1, NULL
UNION ALL SELECT '[UNK]', NULL, (SELECT nv FROM n) + 2, NULL
UNION ALL SELECT '[CLS]', NULL, (SELECT nv FROM n) + 3, NULL
UNION ALL SELECT '[SEP]', NULL, (SELECT nv FROM n) + 4, NULL"""


def _sent(spark, sf_dir):
    return C.sentences(V.v_sent(spark, sf_dir), "holdings", keep=KEYS)


def _vocab(spark, sf_dir):
    return C.vocabulary(_sent(spark, sf_dir))


def _text(col):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), " ")


# ---------------------------------------------------------------- TOK
def tok01_sentences(spark, sf_dir):
    return _sent(spark, sf_dir).select(*KEYS, F.array_join("tokens", " ").alias("sentence"))


TOK01_SQL = f"WITH t AS ({T_SQL}) SELECT holder, end_date, string_agg(token, ' ' ORDER BY pos) AS sentence FROM t GROUP BY ALL"


def tok04_distinct_tokens(spark, sf_dir):
    return C.distinct_tokens(_sent(spark, sf_dir))


TOK04_SQL = f"WITH t AS ({T_SQL}) SELECT DISTINCT token FROM t"


def tok05_token_counts(spark, sf_dir):
    return C.token_counts(_sent(spark, sf_dir), min_count=2)


TOK05_SQL = f"WITH t AS ({T_SQL}) SELECT token, count(*) AS count FROM t GROUP BY token HAVING count(*) >= 2"


def tok06_vocabulary(spark, sf_dir):
    return _vocab(spark, sf_dir).select("token", "index", "count")


TOK06_SQL = f"SELECT token, idx AS index, cnt AS count FROM ({VOCAB_SQL})"


def tok07_index_to_token(spark, sf_dir):
    return _vocab(spark, sf_dir).select("index", "token")


TOK07_SQL = f"SELECT idx AS index, token FROM ({VOCAB_SQL})"


def tok10_subsample(spark, sf_dir):
    return C.subsample(_sent(spark, sf_dir), KEYS, sample=1e-3, seed=SEED).select(
        *KEYS, F.array_join("tokens", " ").alias("kept"))


TOK10_SQL = f"""WITH t AS ({T_SQL}),
c AS (SELECT token, count(*) AS cnt FROM t GROUP BY token),
tot AS (SELECT sum(cnt) AS total FROM c),
j AS (SELECT t.*, 0.001 * (SELECT total FROM tot) / c.cnt AS r FROM t JOIN c USING (token))
SELECT holder, end_date, string_agg(token, ' ' ORDER BY pos) AS kept FROM j
WHERE {uniform_sql(SEED, 'subsample', 'holder', 'end_date', 'pos')} < least(1.0, sqrt(r) + r)
GROUP BY holder, end_date"""


def tok10_duplicate_keys(spark, sf_dir):
    """Subsampling with a key that many rows share (the holder alone)."""
    sent = _sent(spark, sf_dir).select("holder", "tokens")
    return C.subsample(sent, ["holder"], sample=1e-3, seed=SEED).select("holder", F.array_join("tokens", " ").alias("kept"))


TOK10_DUP_SQL = f"""WITH t AS ({T_SQL}),
c AS (SELECT token, count(*) AS cnt FROM t GROUP BY token),
tot AS (SELECT sum(cnt) AS total FROM c),
j AS (SELECT t.*, 0.001 * (SELECT total FROM tot) / c.cnt AS r FROM t JOIN c USING (token))
SELECT holder, string_agg(token, ' ' ORDER BY pos) AS kept FROM j
WHERE {uniform_sql(SEED, 'subsample', 'holder', 'pos')} < least(1.0, sqrt(r) + r)
GROUP BY holder, end_date"""


def tok09_vocab_size(spark, sf_dir):
    """Size of the vocabulary with its special tokens, checked as a model would."""
    vocab = _vocab(spark, sf_dir)
    size = vocab.count()
    C.check_vocab_size(vocab, size)
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"), F.max("index").alias("last_index"))


TOK09_SQL = f"""WITH t AS ({T_SQL})
SELECT count(DISTINCT token) + 5 AS vocab_size, count(DISTINCT token) + 4 AS last_index FROM t"""


def _alias(spark, sf_dir):
    return V.v_alias(spark, sf_dir)


def tok11_alias_maps(spark, sf_dir):
    n2c, c2n = C.alias_maps(_alias(spark, sf_dir))
    return (n2c.select(F.lit("name_to_code").alias("map"), F.col("name").alias("k"), F.col("code").alias("v"))
            .unionByName(c2n.select(F.lit("code_to_name").alias("map"), F.col("code").alias("k"), F.col("name").alias("v"))))


ALIAS_SQL = f"SELECT {_pad_sql('CAST(p_partkey AS VARCHAR)')} AS code, p_name AS name, p_partkey AS ord FROM part"
TOK11_SQL = f"""WITH a AS ({ALIAS_SQL})
SELECT 'name_to_code' AS map, name AS k, arg_max(code, ord) AS v FROM a GROUP BY name
UNION ALL SELECT 'code_to_name', code, arg_max(name, ord) FROM a GROUP BY code"""


def tok12_encode(spark, sf_dir):
    p = V.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    texts = (p.select("p_partkey", F.lit("name").alias("kind"), F.col("p_name").alias("text"))
             .unionByName(p.select("p_partkey", F.lit("code").alias("kind"), F.col("p_partkey").cast("string").alias("text"))))
    n2c, _ = C.alias_maps(_alias(spark, sf_dir))
    return C.encode(texts, "text", _vocab(spark, sf_dir), n2c, out="id").select("p_partkey", "kind", "text", "id")


TOK12_SQL = f"""WITH v AS ({VOCAB_SQL}), a AS ({ALIAS_SQL}),
n2c AS (SELECT name, arg_max(code, ord) AS code FROM a GROUP BY name),
x AS (SELECT p_partkey, 'name' AS kind, p_name AS text FROM part
      UNION ALL SELECT p_partkey, 'code', CAST(p_partkey AS VARCHAR) FROM part),
y AS (SELECT x.*, {_pad_sql('coalesce(n2c.code, x.text)')} AS tok FROM x LEFT JOIN n2c ON x.text = n2c.name)
SELECT p_partkey, kind, text, coalesce(v.idx, (SELECT idx FROM v WHERE token = '[UNK]' AND raw IS NULL)) AS id
FROM y LEFT JOIN (SELECT * FROM v WHERE raw IS NOT NULL) v ON y.tok = v.token"""


def tok13_decode(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    _, c2n = C.alias_maps(_alias(spark, sf_dir))
    ids = vocab.select(F.col("index").alias("id"))
    return C.decode(ids, "id", vocab, c2n, mode="name", out="decoded")


TOK13_SQL = f"""WITH v AS ({VOCAB_SQL}), a AS ({ALIAS_SQL}),
c2n AS (SELECT code, arg_max(name, ord) AS name FROM a GROUP BY code)
SELECT v.idx AS id, coalesce(c2n.name, v.token) AS decoded FROM v LEFT JOIN c2n ON v.token = c2n.code"""


# ---------------------------------------------------------------- MLM
def _ids_sql(max_length=None):
    cut = f"WHERE pos < {max_length}" if max_length else ""
    return f"""WITH t AS ({T_SQL}), v AS ({VOCAB_SQL}),
info AS (SELECT max(idx) FILTER (WHERE token = '[UNK]' AND raw IS NULL) AS unk_id,
                max(idx) FILTER (WHERE token = '[PAD]' AND raw IS NULL) AS pad_id,
                max(idx) FILTER (WHERE token = '[MASK]' AND raw IS NULL) AS mask_id,
                count(*) AS vocab_len FROM v),
ids AS (SELECT t.holder, t.end_date, t.pos, coalesce(v.idx, (SELECT unk_id FROM info)) AS id
        FROM (SELECT * FROM t {cut}) t LEFT JOIN v ON t.token = v.token)"""


def mlm01_token_ids(spark, sf_dir):
    ids = M.token_ids(_sent(spark, sf_dir), KEYS, _vocab(spark, sf_dir))
    return ids.select(*KEYS, _text("input_ids").alias("input_ids"))


MLM01_SQL = _ids_sql() + """
SELECT holder, end_date, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS input_ids FROM ids GROUP BY ALL"""


def mlm01_duplicate_keys(spark, sf_dir):
    """Ids with a key that many rows share: one result row per input row."""
    ids = M.token_ids(_sent(spark, sf_dir).select("holder", "tokens"), ["holder"], _vocab(spark, sf_dir))
    return ids.select("holder", _text("input_ids").alias("input_ids"))


MLM01_DUP_SQL = _ids_sql() + """
SELECT holder, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS input_ids FROM ids GROUP BY holder, end_date"""


def _rows_sql(max_length, mask_prob, random_prob):
    L = max_length
    u = lambda k: uniform_sql(SEED, "mlm", "holder", "end_date", "pos", k=k)
    return _ids_sql(L) + f""",
lens AS (SELECT holder, end_date, count(*) AS n FROM ids GROUP BY ALL),
grid AS (SELECT holder, end_date, n, unnest(range(0, {L})) AS pos FROM lens),
full_ids AS (SELECT g.holder, g.end_date, g.pos, coalesce(i.id, (SELECT pad_id FROM info)) AS id,
                    CASE WHEN g.pos < g.n THEN 1 ELSE 0 END AS att
             FROM grid g LEFT JOIN ids i ON g.holder = i.holder AND g.end_date = i.end_date AND g.pos = i.pos),
m AS (SELECT *, id < (SELECT mask_id FROM info) AND {u(0)} < {mask_prob} AS chosen FROM full_ids),
r AS (SELECT *, CASE WHEN chosen THEN id ELSE -100 END AS label,
        CASE WHEN chosen AND {u(2)} < {random_prob}
             THEN CAST(floor({u(3)} * (SELECT vocab_len FROM info)) AS INTEGER)
             WHEN chosen THEN (SELECT mask_id FROM info) ELSE id END AS input_id
      FROM m)
SELECT holder, end_date, string_agg(CAST(input_id AS VARCHAR), ' ' ORDER BY pos) AS input_ids,
       string_agg(CAST(att AS VARCHAR), ' ' ORDER BY pos) AS attention_mask,
       string_agg(CAST(label AS VARCHAR), ' ' ORDER BY pos) AS labels
FROM r GROUP BY ALL"""


def _rows(spark, sf_dir, **kw):
    sent = staged(_sent(spark, sf_dir), "sentences")        # read by the vocabulary and the rows
    r = M.training_rows(sent, KEYS, C.vocabulary(sent), seed=SEED, **kw)
    return r.select(*KEYS, _text("input_ids").alias("input_ids"), _text("attention_mask").alias("attention_mask"),
                    _text("labels").alias("labels"))


def mlm02_cut_and_pad(spark, sf_dir):
    return _rows(spark, sf_dir, max_length=8, mask_prob=0.0)


def mlm08_training_rows(spark, sf_dir):
    return _rows(spark, sf_dir, max_length=20, mask_prob=0.15, random_prob=0.1)


def mlm08_training_rows_len50(spark, sf_dir):
    return _rows(spark, sf_dir, max_length=50, mask_prob=0.15, random_prob=0.1)


def _year_files(spark, sf_dir):
    """Baskets as annual files: file_name = merged_<year of end_date>."""
    s = V.v_sent(spark, sf_dir)
    return s.withColumn("file_name", F.concat(F.lit("merged_"), F.year("end_date").cast("string")))


def mlm09_rows_per_file(spark, sf_dir):
    return M.rows_per_file(_year_files(spark, sf_dir))


FILES_SQL = f"""WITH t AS ({T_SQL}) SELECT DISTINCT holder, end_date, 'merged_' || CAST(year(end_date) AS VARCHAR) AS file_name FROM t"""
MLM09_SQL = f"SELECT file_name, count(*) AS n_rows FROM ({FILES_SQL}) GROUP BY file_name"


def mlm10_locate(spark, sf_dir):
    from panelspark.operators.indexing import global_index
    f = _year_files(spark, sf_dir)
    offsets = M.file_offsets(M.rows_per_file(f))
    indexed = global_index(f.select("file_name", *KEYS), ["file_name", *KEYS], "idx")
    loc = M.locate(indexed.select(*KEYS, "idx"), offsets)
    return loc.select(*KEYS, "idx", "file_name", "line")


MLM10_SQL = f"""SELECT holder, end_date, row_number() OVER (ORDER BY file_name, holder, end_date) - 1 AS idx, file_name,
       row_number() OVER (PARTITION BY file_name ORDER BY holder, end_date) - 1 AS line FROM ({FILES_SQL})"""


def mlm11_batches(spark, sf_dir):
    b = M.shuffle_batches(V.v_sent(spark, sf_dir), KEYS, batch_size=32, seed=SEED)
    return b.select(*KEYS, "sample_idx", "batch_id")


MLM11_SQL = f"""WITH k AS (SELECT DISTINCT holder, end_date FROM ({T_SQL})),
o AS (SELECT holder, end_date, row_number() OVER (ORDER BY {uniform_sql(SEED, 'shuffle', 'holder', 'end_date')}, holder, end_date) - 1 AS sample_idx FROM k)
SELECT holder, end_date, sample_idx, sample_idx // 32 AS batch_id FROM o"""


BUCKETS = 64


def mlm11_permuted_batches(spark, sf_dir):
    b = M.permuted_batches(V.v_sent(spark, sf_dir), KEYS, batch_size=32, seed=SEED, buckets=BUCKETS)
    return b.select(*KEYS, "sample_idx", "batch_id")


MLM11P_SQL = f"""WITH k AS (SELECT DISTINCT holder, end_date FROM ({T_SQL})),
b AS (SELECT holder, end_date, CAST('0x' || substr(md5(concat_ws(':', holder, end_date)), 1, 8) AS BIGINT) % {BUCKETS} AS bucket,
    count(*) OVER () AS n FROM k),
i AS (SELECT holder, end_date, n, row_number() OVER (ORDER BY bucket, holder, end_date) - 1 AS i FROM b),
o AS (SELECT holder, end_date, CAST({feistel_sql('i', 'n', SEED)} AS BIGINT) AS sample_idx FROM i)
SELECT holder, end_date, sample_idx, sample_idx // 32 AS batch_id FROM o"""


# ---------------------------------------------------------------- EMB
def emb01_skipgram(spark, sf_dir):
    """Trained tokens and their dimensions with the reference trainer's settings: skip-gram with 10 negative
    samples, frequent tokens subsampled (sample 1e-3, TOK-10), dim 100, window 5, min count 1, 10 passes."""
    sent = staged(_sent(spark, sf_dir), "sentences")        # read by the counts and the rows
    sub = C.subsample(sent, KEYS, sample=1e-3, seed=SEED)
    vec = SG.train_skipgram(sub, vector_size=100, window=5, min_count=1, epochs=10, negative=10, seed=SEED)
    return vec.select("token", F.size("vector").alias("n_dims"))


def emb01_word2vec(spark, sf_dir):
    """Trained tokens and their dimensions with the reference trainer's
    settings: frequent tokens subsampled (sample 1e-3, TOK-10), dim 100,
    window 5, min count 1, 10 passes.  Spark's Word2Vec differs from the
    reference's trainer, so the vectors themselves have no SQL oracle; the
    token set and shape do.  A vocabulary beyond the driver's budget is trained in blocks."""
    sent = staged(_sent(spark, sf_dir), "sentences")        # read by the counts and the rows
    sub = C.subsample(sent, KEYS, sample=1e-3, seed=SEED)
    _, vec = EM.train_word2vec(sub, vector_size=100, window=5, min_count=1, max_iter=10, seed=SEED)
    return vec.select("token", F.size("vector").alias("n_dims"))


EMB01_SQL = f"""WITH t AS ({T_SQL}),
c AS (SELECT token, count(*) AS cnt FROM t GROUP BY token),
tot AS (SELECT sum(cnt) AS total FROM c),
j AS (SELECT t.*, 0.001 * (SELECT total FROM tot) / c.cnt AS r FROM t JOIN c USING (token))
SELECT DISTINCT token, CAST(100 AS INTEGER) AS n_dims FROM j
WHERE {uniform_sql(SEED, 'subsample', 'holder', 'end_date', 'pos')} < least(1.0, sqrt(r) + r)"""


def _vec(spark, sf_dir):
    return V.v_vec(spark, sf_dir)


def emb02_vector_of(spark, sf_dir):
    v = EM.vector_of(_vec(spark, sf_dir), "7")
    return v.select("token", F.posexplode("vector").alias("pos", "value")).select(
        "token", F.col("pos").cast("long").alias("pos"), F.round(F.col("value").cast("double"), 6).alias("value"))


EMB02_SQL = """SELECT '7' AS token, generate_subscripts(embedding, 1) - 1 AS pos, round(CAST(unnest(embedding) AS DOUBLE), 6) AS value
FROM embeddings WHERE vec_id = 7"""


def emb03_matrix(spark, sf_dir):
    vv = _vec(spark, sf_dir)
    m = EM.embedding_matrix(vv.select("token", "index"), vv.select("token", "vector"), seed=SEED, join_on="token")
    return m.select("index", F.posexplode("vector").alias("pos", "value")).select(
        "index", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


EMB03_SQL = f"""WITH e AS (SELECT vec_id AS idx, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
           FROM embeddings),
n AS (SELECT count(*) AS nv FROM embeddings),
d AS (SELECT pos, sum(x) AS s, coalesce(sum(x) FILTER (WHERE idx < 2), 0) AS s01, sum(x * x) AS q,
             coalesce(sum(x * x) FILTER (WHERE idx < 2), 0) AS q01 FROM e GROUP BY pos),
dm AS (SELECT *, (s + s01) / ((SELECT nv FROM n) + 5) AS mask_x FROM d),
st AS (SELECT sum(s + s01 + mask_x) / (count(*) * ((SELECT nv FROM n) + 5)) AS mu,
              sqrt(greatest(sum(q + q01 + mask_x * mask_x) / (count(*) * ((SELECT nv FROM n) + 5))
                   - pow(sum(s + s01 + mask_x) / (count(*) * ((SELECT nv FROM n) + 5)), 2), 0)) AS sd FROM dm),
u AS (SELECT pos, {uniform_sql(SEED, 'unk/a', 'pos')} AS u1, {uniform_sql(SEED, 'unk/b', 'pos')} AS u2 FROM d)
SELECT idx AS index, pos, round(x, 6) AS value FROM e
UNION ALL SELECT (SELECT nv FROM n), pos, round(mask_x, 6) FROM dm
UNION ALL SELECT (SELECT nv FROM n) + 1, pos, 0.0 FROM d
UNION ALL SELECT (SELECT nv FROM n) + 2, pos,
   round((SELECT mu FROM st) + (SELECT sd FROM st) * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2), 6) FROM u
UNION ALL SELECT (SELECT nv FROM n) + 3 + idx, pos, round(x, 6) FROM e WHERE idx < 2"""


def tok02_pad_ids(spark, sf_dir):
    from panelspark.functions.scalars import pad_id
    p = V.table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("raw"))
    big = p.select("p_partkey", F.concat(F.col("raw"), F.col("raw")).alias("raw"))   # 2..8 digits: never cut
    both = p.withColumn("kind", F.lit("key")).unionByName(big.withColumn("kind", F.lit("doubled")))
    return both.select("p_partkey", "kind", "raw", pad_id("raw").alias("padded"))


TOK02_SQL = f"""WITH p AS (SELECT p_partkey, 'key' AS kind, CAST(p_partkey AS VARCHAR) AS raw FROM part
  UNION ALL SELECT p_partkey, 'doubled', CAST(p_partkey AS VARCHAR) || CAST(p_partkey AS VARCHAR) FROM part)
SELECT p_partkey, kind, raw, {_pad_sql('raw')} AS padded FROM p"""


def tok08_special_tokens(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    return v.filter(F.col("raw").isNull()).select("token", "index")


TOK08_SQL = f"SELECT token, idx AS index FROM ({VOCAB_SQL}) WHERE raw IS NULL"


def _matrix_long(spark, sf_dir):
    vv = _vec(spark, sf_dir)
    m = EM.embedding_matrix(vv.select("token", "index"), vv.select("token", "vector"), seed=SEED, join_on="token")
    n = vv.select(F.count(F.lit(1))).scalar()
    return m.select("index", F.posexplode("vector").alias("pos", "value")).select(
        (F.col("index") - n).alias("offset"), F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


def emb04_mask_row(spark, sf_dir):
    return _matrix_long(spark, sf_dir).filter(F.col("offset") == 0).select("pos", "value")


def emb05_unk_row(spark, sf_dir):
    return _matrix_long(spark, sf_dir).filter(F.col("offset") == 2).select("pos", "value")


QUERIES = {
    "tok01_sentences": tok01_sentences,
    "tok02_pad_ids": tok02_pad_ids,
    "tok08_special_tokens": tok08_special_tokens,
    "emb04_mask_row": emb04_mask_row,
    "emb05_unk_row": emb05_unk_row,
    "tok04_distinct_tokens": tok04_distinct_tokens,
    "tok05_token_counts": tok05_token_counts,
    "tok06_vocabulary": tok06_vocabulary,
    "tok07_index_to_token": tok07_index_to_token,
    "tok10_subsample": tok10_subsample,
    "tok11_alias_maps": tok11_alias_maps,
    "tok12_encode": tok12_encode,
    "tok13_decode": tok13_decode,
    "mlm01_token_ids": mlm01_token_ids,
    "mlm02_cut_and_pad": mlm02_cut_and_pad,
    "mlm08_training_rows": mlm08_training_rows,
    "mlm08_training_rows_len50": mlm08_training_rows_len50,
    "mlm09_rows_per_file": mlm09_rows_per_file,
    "mlm10_locate": mlm10_locate,
    "mlm11_batches": mlm11_batches,
    "mlm11_permuted_batches": mlm11_permuted_batches,
    "emb01_skipgram": emb01_skipgram,
    "emb01_word2vec": emb01_word2vec,
    "tok09_vocab_size": tok09_vocab_size,
    "tok10_duplicate_keys": tok10_duplicate_keys,
    "mlm01_duplicate_keys": mlm01_duplicate_keys,
    "emb02_vector_of": emb02_vector_of,
    "emb03_matrix": emb03_matrix,
}

ORACLE = {
    "tok01_sentences": TOK01_SQL,
    "tok02_pad_ids": TOK02_SQL,
    "tok08_special_tokens": TOK08_SQL,
    "emb04_mask_row": f"SELECT pos, value FROM ({EMB03_SQL}) WHERE index = (SELECT count(*) FROM embeddings)",
    "emb05_unk_row": f"SELECT pos, value FROM ({EMB03_SQL}) WHERE index = (SELECT count(*) FROM embeddings) + 2",
    "tok04_distinct_tokens": TOK04_SQL,
    "tok05_token_counts": TOK05_SQL,
    "tok06_vocabulary": TOK06_SQL,
    "tok07_index_to_token": TOK07_SQL,
    "tok09_vocab_size": TOK09_SQL,
    "tok10_subsample": TOK10_SQL,
    "tok10_duplicate_keys": TOK10_DUP_SQL,
    "mlm01_duplicate_keys": MLM01_DUP_SQL,
    "mlm11_permuted_batches": MLM11P_SQL,
    "emb01_skipgram": EMB01_SQL,
    "emb01_word2vec": EMB01_SQL,
    "tok11_alias_maps": TOK11_SQL,
    "tok12_encode": TOK12_SQL,
    "tok13_decode": TOK13_SQL,
    "mlm01_token_ids": MLM01_SQL,
    "mlm02_cut_and_pad": _rows_sql(8, 0.0, 0.1),
    "mlm08_training_rows": _rows_sql(20, 0.15, 0.1),
    "mlm08_training_rows_len50": _rows_sql(50, 0.15, 0.1),
    "mlm09_rows_per_file": MLM09_SQL,
    "mlm10_locate": MLM10_SQL,
    "mlm11_batches": MLM11_SQL,
    "emb02_vector_of": EMB02_SQL,
    "emb03_matrix": EMB03_SQL,
}
