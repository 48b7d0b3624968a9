"""Whole-text tokenization by distinct words (used by OP 1 and OP 9).

The tokenizer of ``word_bpe_49k.json`` never lets a piece cross white space,
so a text's ids are the ids of its ASCII-white-space words in order.  Each
batch is split in Arrow, its words are numbered (dictionary encoding), each
distinct word is encoded once by the ``tokenizers`` library and the ids are
gathered back, so the library sees every distinct word of a batch and
nothing is cut off.  A cache of bounded size carries words from batch to
batch within a Python worker.

Words of plain Latin letters, digits and punctuation (no ``<``, which could
begin a special token) are further cut into the pre-tokenizer's pieces;
all others go to the library whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from panelspark.llm.common import ship, worker_state

ship(__name__)

CACHE_WORDS = 600_000       # entries kept per worker; more only costs a re-encode
SLICE_BYTES = 16 << 20       # text bytes worked on at a time within a batch

# Characters for which lower-casing, NFC and the split pattern
# of the tokenizer file act within a word as the pieces below say.
PLAIN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
SIMPLE = "^(?P<core>[a-zß-öø-ÿ]*)(?P<tail>[!-/:;=-@\\[-`{-~]*)$"
NOT_PLAIN = "[^!-;=-~À-ÖØ-öø-ÿ]"
WORD_END = "</w>"


def tokenizer_json(path: str | None = None) -> str:
    """Content of the tokenizer file (about 2 MB, whatever the data)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class LibraryWords:
    """words -> little-endian uint32 ids (bytes), by the library."""

    def __init__(self, content: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(content)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for t, i in vocab.items():
            self.ends[i] = t.endswith(WORD_END)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pre-tokenizer pieces: each ends in its one word-end token."""
        out: list[bytes] = []
        for k in range(0, len(pieces), 2000):
            part = pieces[k:k + 2000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(last) != sum(map(bool, part)):
                raise ValueError("a piece did not end in exactly one word-end token")
            raw, ends, at = ids.tobytes(), iter(last), 0
            for p in part:
                e = next(ends) if p else at
                out.append(raw[at:e])
                at = e
        return out

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts, by the library."""
        done = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]


class WordCache:
    """Values of words, from a bounded piece -> value table.

    ``encoder.pieces`` gives the values of single pieces, ``encoder.whole``
    those of any other words.
    """

    def __init__(self, encoder, limit: int = CACHE_WORDS):
        self.encoder, self.limit, self.known = encoder, limit, {}

    def lookup(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        missing = [p for p in pieces if p not in known]
        if missing:
            if len(known) + len(missing) > self.limit:
                known.clear()
                missing = pieces
            known.update(zip(missing, self.encoder.pieces(missing)))
        return [known[p] for p in pieces]

    def _mixed(self, words: list[str]) -> list[bytes]:
        split = [PIECES.findall(w.lower()) if PLAIN.fullmatch(w) else None for w in words]
        distinct = list({p for s in split if s is not None for p in s})
        get = dict(zip(distinct, self.lookup(distinct))).__getitem__
        out = [b"" if s is None else b"".join(map(get, s)) for s in split]
        odd = [i for i, s in enumerate(split) if s is None and words[i]]
        for i, v in zip(odd, self.encoder.whole([words[i] for i in odd]) if odd else ()):
            out[i] = v
        return out

    def encode_words(self, words: pa.Array) -> pa.Array:
        """Values of distinct words; a word that is letters and then
        punctuation is two pieces, each looked up once."""
        parts = pc.extract_regex(pc.utf8_lower(words), SIMPLE)
        odd = pc.fill_null(pc.or_(parts.is_null(), pc.match_substring_regex(words, NOT_PLAIN)), True)
        plain = parts.filter(pc.invert(odd))
        empty = pa.scalar(b"", pa.large_binary())
        halves = []
        for name in ("core", "tail"):
            enc = pc.struct_field(plain, name).dictionary_encode()
            halves.append(pa.array(self.lookup(enc.dictionary.to_pylist()), pa.large_binary()).take(enc.indices))
        joined = pc.binary_join_element_wise(*halves, empty)
        other = pa.array(self._mixed(words.filter(odd).to_pylist()), pa.large_binary())
        odd = odd.to_numpy(zero_copy_only=False)
        place = np.empty(len(odd), np.int64)
        place[~odd] = np.arange(len(joined))
        place[odd] = len(joined) + np.arange(len(other))
        return pa.concat_arrays([joined, other]).take(pa.array(place))


def library_cache(content: str) -> WordCache:
    return worker_state(("library_words", hash(content)), lambda: WordCache(LibraryWords(content)))


def split_words(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Distinct words, word numbers of all words, offsets per text (nulls: none)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    offsets = offsets - offsets[0]
    enc = flat.dictionary_encode()
    return enc.dictionary, enc.indices, offsets


def gather(values: pa.Array, indices: pa.Array, offsets: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """Values of all words end to end, and where each text's bytes begin."""
    taken = values.take(indices)
    at = np.frombuffer(taken.buffers()[1], np.int64, count=len(taken) + 1, offset=taken.offset * 8)
    data = taken.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), at[offsets]


def encode_texts(texts: pa.Array, cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts end to end (uint32) and ``len(texts) + 1`` offsets."""
    words, indices, offsets = split_words(texts)
    data, at = gather(cache.encode_words(words), indices, offsets)
    ids = np.frombuffer(data[at[0]:at[-1]], "<u4") if len(at) else np.zeros(0, "<u4")
    return ids, (at - at[0]) // 4


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    n = len(offsets) - 1
    out = np.empty(len(ids) + n, np.uint32)
    new = offsets + np.arange(n + 1)
    ends = new[1:] - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, new
