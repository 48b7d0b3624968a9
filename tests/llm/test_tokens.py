"""OP 1, 7 and 9 against the tokenizers library."""
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import pack, rans, segment_bpe, token_files, word_tokens
from panelspark.session import scratch_path
from tests.llm.helpers import edge_docs, long_text

TEXTS = ["", None, " ", "Hello  World\n\tdon't !'s O'Reilly", "<|startoftext|>abc<|endoftext|> x", "ÀÉÎ ß µ ª × İstanbul ΣΑΣ",
         "a\xa0b\x1cc\x85d", "日本語 テキスト é ́x", "'sa 's'", "x" * 3000, "aaa'll 've're", "12³ ½ 1,000.5 #!? 😀👍🏽",
         "<|endoftext|><|endoftext|>", "<|STARTOFTEXT|>", "ﬁ ǅ Ⅷ ẞ", long_text(3000)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(word_tokens.tokenizer_json())


@pytest.fixture(scope="module")
def docs(spark):
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return some.union(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))


@pytest.fixture(scope="module")
def expected(docs, library):
    return {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}


def le(ids):
    return np.array(ids, "<u4").tobytes()


def test_bounded_cache_gives_the_same_ids(library):
    small = word_tokens.WordCache(word_tokens.LibraryWords(word_tokens.tokenizer_json()), limit=3)
    ids, at = word_tokens.encode_texts(pa.array(TEXTS, pa.string()), small)
    for i, t in enumerate(TEXTS):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_segment_tree_equals_the_library(spark, docs, expected, library):
    for r in segment_bpe.encode_decode(docs).collect():
        ids = expected[r.doc_id]
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), le(ids), text)
        assert r.ids_sha256 == hashlib.sha256(le(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_segment_tree_merges_like_a_plain_loop():
    bpe = segment_bpe.SegmentTreeBpe(word_tokens.tokenizer_json())
    rng = np.random.default_rng(1)
    for _ in range(100):
        piece = "".join(rng.choice(list("etaoinshr"), rng.integers(1, 40)))
        syms = [bpe.inner[b] for b in piece.encode()]
        syms[-1] = bpe.final[piece.encode()[-1]]
        plain = list(syms)
        while True:
            found = [(bpe.pairs[p][0], i) for i, p in enumerate(zip(plain, plain[1:])) if p in bpe.pairs]
            if not found:
                break
            _, i = min(found)
            plain[i:i + 2] = [bpe.pairs[plain[i], plain[i + 1]][1]]
        assert bpe.merge(syms) == plain


@pytest.mark.parametrize("block", [1 << 18, 700])
def test_token_files_round_trip(spark, docs, expected, block):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, block_tokens=block)
    got = sorted(token_files.token_checksums(spark, path).collect())
    full = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    assert [r.doc_id for r in got] == sorted(expected)
    at = 0
    for r in got:
        ids = expected[r.doc_id] + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(le(ids)))
        assert (full[r.doc_id].start, bytes(full[r.doc_id].ids)) == (at, le(ids))
        at += len(ids)


def test_rans_blocks_and_damage():
    rng = np.random.default_rng(2)
    ids = (rng.zipf(1.3, 50_000) % 3000).astype(np.uint32)
    table = rans.Table.scaled(*np.unique(ids, return_counts=True))
    sizes = np.array([30_000, 1, 0, 63, 19_936])
    blocks = [b | {"n_tokens": int(n)} for b, n in zip(rans.encode(table, ids, sizes), sizes)]
    assert (np.concatenate(rans.decode(table, blocks)) == ids).all()
    assert sum(len(b["words"]) for b in blocks) < 2 * len(ids)
    broken = dict(blocks[0], words=blocks[0]["words"][:-4] + b"\0\0\0\1")
    with pytest.raises(ValueError):
        rans.decode(table, [broken])
    one = rans.Table.scaled([7], [5])
    b = rans.encode(one, np.full(1000, 7, np.uint32), np.array([1000]))[0]
    assert (rans.decode(one, [b | {"n_tokens": 1000}])[0] == 7).all()
    with pytest.raises(ValueError):
        one.symbols(np.array([8], np.uint32))


def test_crc_of_parts():
    x = bytes(range(256)) * 50
    parts = [(zlib.crc32(x[a:b]), b - a) for a, b in ((0, 7), (7, 7), (7, 9000), (9000, len(x)))]
    assert rans.crc32_combine(parts) == zlib.crc32(x)


def test_packing_covers_every_token_once(spark, docs, expected):
    pieces, seen = defaultdict(list), []
    for r in pack.pack(docs, max_len=64).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens, r.length))
        seen.append((r.sequence_id, -r.length))
    assert sorted(s for s, _ in seen) == list(range(len(seen)))
    assert [n for _, n in sorted(seen)] == sorted(n for _, n in seen)       # buckets one after the other
    for k, ids in expected.items():
        mine = sorted(pieces[k])
        assert sum((x[1] for x in mine), []) == ids + [1]
        assert all(x[2] == len(ids) + 1 and x[3] == len(x[1]) for x in mine)
        assert [x[3] for x in mine] == sorted((x[3] for x in mine), reverse=True)
    with pytest.raises(ValueError):
        pack.pack(docs, max_len=100)


def test_edge_rows(spark):
    df = edge_docs(spark)
    n = df.count()
    got = segment_bpe.encode_decode(df).collect()
    assert len(got) == n and sum(r.n_tokens == 0 for r in got) == 3
    path = scratch_path(spark, "test-edge")
    token_files.write_tokens(df, path)
    rows = token_files.token_checksums(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 5, 5, 5, 6, 7, 8]
    assert sum(r.n_tokens == 1 for r in rows) == 3
    assert pack.pack(df).select("sequence_id").distinct().count() == pack.pack(df).count()
    for empty in (segment_bpe.encode_decode(df.limit(0)), pack.pack(df.limit(0))):
        assert empty.count() == 0
    path = scratch_path(spark, "test-none")
    token_files.write_tokens(df.limit(0), path)
    assert token_files.token_checksums(spark, path).count() == 0 and token_files.read_tokens(spark, path).count() == 0
