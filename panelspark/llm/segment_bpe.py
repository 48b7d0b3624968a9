"""OP 7: BPE encoding with a segment tree over adjacent pair ranks, and decoding.

A piece's symbols are the leaves' left members: leaf ``i`` holds the rank of
the pair (symbol ``i``, its right neighbour) and its position, an inner node
the smaller of its children, so the root is the leftmost pair of lowest
rank.  Merging it changes three leaves, each updated in logarithmic time,
until the root says that no mergeable pair remains.

The tokenizer's other parts follow its file: special tokens are found in
the raw text, the rest is normalised (NFC, white space to one space, lower
case), cut by its split pattern and mapped to byte symbols; the last symbol
of a piece carries the word-end suffix.  Decoding joins the tokens of the
ids by single spaces, as the library does for a file without a decoder.

Null and empty texts have no ids and decode to an empty text; repeated rows
are encoded each; other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import word_tokens as WT
from panelspark.llm.common import byte_slices, ship, worker_state

ship(__name__)

INF = 1 << 62


class SegmentTreeBpe:
    """Encoder for the tokenizer file's BPE model (see the module text)."""

    def __init__(self, content: str):
        import regex
        spec = json.loads(content)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        # Printable bytes stand for themselves, the others are
        # numbered from 256 on (the usual byte alphabet of byte-level BPE).
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        char = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.inner = [vocab[char[b]] for b in range(256)]
        self.final = [vocab[char[b] + self.suffix] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        size = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = t.encode() + b" "
        self.tokens = pa.array(tokens, pa.large_binary())

    def merge(self, syms: list[int]) -> list[int]:
        """Ids of one piece given its byte symbols."""
        n = len(syms)
        if n < 2:
            return syms
        pairs = self.pairs.get
        size = 1
        while size < n - 1:
            size *= 2
        tree = [INF] * (2 * size)
        made = [0] * n
        for i in range(n - 1):
            hit = pairs((syms[i], syms[i + 1]))
            if hit:
                tree[size + i] = hit[0] * n + i
                made[i] = hit[1]
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        left = list(range(-1, n - 1))
        right = list(range(1, n + 1))

        def put(leaf: int, value: int) -> None:
            k = size + leaf
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        while tree[1] < INF:
            i = tree[1] % n
            gone = right[i]
            syms[i] = made[i]
            after = right[gone]
            right[i] = after
            if gone < n - 1:
                put(gone, INF)
            if after < n:
                left[after] = i
                hit = pairs((syms[i], syms[after]))
                made[i] = hit[1] if hit else 0
                put(i, hit[0] * n + i if hit else INF)
            else:
                put(i, INF)
            before = left[i]
            if before >= 0:
                hit = pairs((syms[before], syms[i]))
                made[before] = hit[1] if hit else 0
                put(before, hit[0] * n + before if hit else INF)
        out, i = [], 0
        while i < n:
            out.append(syms[i])
            i = right[i]
        return out

    def piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        if not raw:
            return []
        syms = [self.inner[b] for b in raw]
        syms[-1] = self.final[raw[-1]]
        return self.merge(syms)

    def text(self, text: str) -> list[int]:
        """Ids of any text, special tokens included."""
        out: list[int] = []
        at = 0
        spans = [m.span() for m in self.special_at.finditer(text)] if self.special_at else []
        for a, b in [*spans, (len(text), len(text))]:
            plain = unicodedata.normalize("NFC", text[at:a])
            plain = "".join([c.lower() for c in plain])
            for m in self.split.finditer(plain):
                out.extend(self.piece(m.group()))
            if b > a:
                out.append(self.special[text[a:b]])
            at = b
        return out

    # interface of word_tokens.WordCache
    def pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array(self.piece(p), "<u4").tobytes() for p in pieces]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.text(t), "<u4").tobytes() for t in texts]


def decode_ids(ids: np.ndarray, offsets: np.ndarray, tokens: pa.Array):
    """Decoded UTF-8 bytes per text: tokens joined by spaces."""
    taken = tokens.take(pa.array(ids))
    at = np.frombuffer(taken.buffers()[1], np.int64, count=len(taken) + 1)[offsets].tolist()
    data = memoryview(taken.buffers()[2] or b"")
    return [data[a:max(a, b - 1)] for a, b in zip(at, at[1:])]


SCHEMA = "n_tokens long, ids binary, decoded string, ids_sha256 string, decoded_sha256 string"


def encode_decode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer_path: str | None = None, digest_only: bool = False) -> DataFrame:
    """One row per row of ``df``: the id column, ``n_tokens``, ``ids``
    (little-endian uint32), ``decoded`` and the SHA-256 of both.

    ``digest_only`` leaves ``ids`` and ``decoded`` out of the result.
    """
    src = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text_"))
    content = df.sparkSession.sparkContext.broadcast(WT.tokenizer_json(tokenizer_path))  # a vocabulary file: fixed size
    id_type = src.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}" if not digest_only else (
        f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def task(batches):
        bpe = worker_state(("segment_bpe", hash(content.value)), lambda: SegmentTreeBpe(content.value))
        cache = worker_state(("segment_words", hash(content.value)), lambda: WT.WordCache(bpe))
        for batch in batches:
            for part in byte_slices(batch, 1, WT.SLICE_BYTES):
                ids, offsets = WT.encode_texts(part.column(1), cache)
                raw = memoryview(np.ascontiguousarray(ids)).cast("B") if len(ids) else memoryview(b"")
                spans = list(zip((offsets[:-1] * 4).tolist(), (offsets[1:] * 4).tolist()))
                decoded = decode_ids(ids, offsets, bpe.tokens)
                cols = {id_col: part.column(0), "n_tokens": pa.array(np.diff(offsets))}
                if not digest_only:
                    cols["ids"] = pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary())
                    cols["decoded"] = pa.array([str(d, "utf-8") for d in decoded], pa.string())
                cols["ids_sha256"] = pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in spans])
                cols["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded])
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return src.mapInArrow(task, schema)


def op7_segment_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: encoded, decoded, digests of both."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_decode(docs, digest_only=True)
