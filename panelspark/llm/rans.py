"""Static range asymmetric numeral coding of token ids, vectorised over lanes.

A block holds ``steps x LANES`` symbols, symbol ``i`` in lane ``i % LANES``.
Each lane is a 64-bit state in ``[2**31, 2**63)`` that gives off 32-bit
words; the lanes of a block share one word stream, in (step, lane) order as
the decoder needs them.  Every ``CHECK_STEPS`` steps the lane states and
the place in the stream are kept (a checkpoint), so a decoder may begin at
any of them and decodes all stretches of all blocks side by side.

``Table`` is the shared static model: one frequency per distinct id, scaled
to ``2**scale_bits``, the same for all blocks of a file.
"""

from __future__ import annotations

import zlib

import numpy as np

from panelspark.llm.common import ragged, ship

ship(__name__)

LANES = 64
CHECK_STEPS = 256
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MASK32 = np.uint64(0xFFFFFFFF)


class Table:
    """Frequencies of ``ids`` (sorted, distinct), scaled to ``2**bits``."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, bits: int):
        self.ids, self.bits = np.asarray(ids, np.uint32), bits
        self.freq = np.asarray(freq, np.uint64)
        if int(self.freq.sum()) != 1 << bits or (self.freq == 0).any():
            raise ValueError("the frequencies must be positive and sum to the scale")
        self.cum = np.cumsum(self.freq) - self.freq

    @staticmethod
    def scaled(ids, counts, bits: int = 20) -> "Table":
        """From counts over the whole corpus; every seen id keeps a share."""
        order = np.argsort(np.asarray(ids, np.uint32), kind="stable")
        ids = np.asarray(ids, np.uint32)[order]
        counts = np.asarray(counts, np.float64)[order]
        while len(ids) * 4 > 1 << bits:
            bits += 1
        if bits > 26:
            raise ValueError("more distinct ids than the coder's tables are made for")
        freq = np.maximum(1, np.rint(counts / counts.sum() * (1 << bits))).astype(np.int64)
        over = int(freq.sum()) - (1 << bits)
        for k in np.argsort(-freq, kind="stable"):
            if over == 0:
                break
            cut = over if over < 0 else min(over, int(freq[k]) // 2)
            freq[k] -= cut
            over -= cut
        return Table(ids, freq, bits)

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_lookup"):
            small = len(self.ids) and self.ids[-1] < 1 << 24
            self._lookup = np.full(int(self.ids[-1]) + 1, -1, np.int32) if small else None
            if small:
                self._lookup[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        ids = ids.astype(np.uint32, copy=False)
        if self._lookup is None:
            sym = np.searchsorted(self.ids, ids)
            sym[self.ids[np.minimum(sym, len(self.ids) - 1)] != ids] = -1
        else:
            if len(ids) and int(ids.max()) >= len(self._lookup):
                raise ValueError("an id is not in the table")
            sym = self._lookup[ids]
        if len(sym) and int(sym.min()) < 0:
            raise ValueError("an id is not in the table")
        return sym.astype(np.int32)

    def slots(self):
        """Symbol, frequency and offset in the symbol for each slot."""
        if not hasattr(self, "_slots"):
            sym = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
            bias = (np.arange(1 << self.bits, dtype=np.int64) - self.cum.astype(np.int64)[sym]).astype(np.uint32)
            self._slots = sym, self.freq.astype(np.uint32)[sym], bias
        return self._slots


def encode(table: Table, ids: np.ndarray, lengths: np.ndarray) -> list[dict]:
    """Blocks of the given lengths, one after the other in ``ids``.

    Returns for each: ``words`` and ``states`` (bytes), ``marks`` (place of
    each checkpoint in the words) and the CRC-32 of ids and words.
    """
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    steps = -(-lengths[order] // LANES)
    starts = (np.cumsum(lengths) - lengths)[order]
    pad = np.int32(np.argmax(table.freq))
    depth = int(steps[0]) if n else 0
    grid = np.full((n, depth, LANES), pad, np.int32)
    flat = table.symbols(ids)
    for row, (b, s) in enumerate(zip(order, starts)):
        grid[row].reshape(-1)[:lengths[b]] = flat[s:s + lengths[b]]
    shift, bits = np.uint64(63 - table.bits), np.uint64(table.bits)
    x = np.full((n, LANES), LOW, np.uint64)
    words, owner = [], []
    given = np.zeros(n, np.int64)
    marks = [[] for _ in range(n)]
    states = [[] for _ in range(n)]
    for t in range(depth - 1, -1, -1):
        a = int(np.searchsorted(-steps, -t, side="left"))     # rows with steps > t
        s = grid[:a, t]
        f, c, xa = table.freq[s], table.cum[s], x[:a]
        over = xa >= (f << shift)
        if over.any():
            words.append((xa[over] & MASK32).astype(np.uint32))
            owner.append(np.nonzero(over)[0].astype(np.int32))
            given[:a] += over.sum(axis=1)
            xa = np.where(over, xa >> WORD, xa)
        q, r = np.divmod(xa, f)
        x[:a] = (q << bits) + r + c
        if t % CHECK_STEPS == 0:
            for row in range(a):
                marks[row].append(int(given[row]))
                states[row].append(x[row].copy())
    out: list[dict] = [{} for _ in range(n)]
    if words:
        words, owner = np.concatenate(words[::-1]), np.concatenate(owner[::-1])
        words = words[np.argsort(owner, kind="stable")]
    else:
        words = np.zeros(0, np.uint32)
    ends = np.cumsum(given)
    for row, b in enumerate(order):
        mine = words[ends[row] - given[row]:ends[row]].astype("<u4").tobytes()
        s = starts[row]
        out[b] = {
            "words": mine,
            "states": np.concatenate(states[row][::-1]).astype("<u8").tobytes() if states[row] else b"",
            "marks": [int(given[row]) - m for m in marks[row][::-1]],
            "words_crc32": zlib.crc32(mine),
            "ids_crc32": zlib.crc32(ids[s:s + lengths[b]].astype("<u4").tobytes()),
        }
    return out


def decode(table: Table, blocks: list[dict]) -> list[np.ndarray]:
    """Ids of each block (``n_tokens`` and the fields of ``encode``)."""
    sym_of, freq_of, bias_of = table.slots()
    for b in blocks:
        if zlib.crc32(b["words"]) != b["words_crc32"]:
            raise ValueError("a block's words do not match their checksum")
    words = np.frombuffer(b"".join(b["words"] for b in blocks), "<u4").astype(np.uint64)
    words = np.append(words, np.uint64(0))
    base = np.cumsum([0] + [len(b["words"]) // 4 for b in blocks])
    steps = [-(-b["n_tokens"] // LANES) for b in blocks]
    x = np.frombuffer(b"".join(b["states"] for b in blocks), "<u8").astype(np.uint64).reshape(-1, LANES)
    place = np.array([base[i] + m for i, b in enumerate(blocks) for m in b["marks"]], np.int64)
    todo = np.array([min(CHECK_STEPS, st - k * CHECK_STEPS) for st, b in zip(steps, blocks) for k in range(len(b["marks"]))],
                    np.int64)
    order = np.argsort(-todo, kind="stable")
    x, place, left = x[order], place[order], todo[order]
    mask, bits = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
    depth = int(left[0]) if len(left) else 0
    grid = np.zeros((len(left), depth, LANES), np.int32)
    for t in range(depth):
        a = int(np.searchsorted(-left, -t, side="left"))
        xa = x[:a]
        slot = xa & mask
        grid[:a, t] = sym_of[slot]
        xa = freq_of[slot].astype(np.uint64) * (xa >> bits) + bias_of[slot]
        need = xa < LOW
        nth = np.cumsum(need, axis=1)
        rows = np.nonzero(need)
        xa[rows] = (xa[rows] << WORD) | words[(place[:a, None] + nth)[rows] - 1]
        place[:a] += nth[:, -1]
        x[:a] = xa
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    out, k = [], 0
    for b in blocks:
        parts = [grid[back[k + j]] for j in range(len(b["marks"]))]
        k += len(parts)
        sym = np.concatenate([p.reshape(-1)[:CHECK_STEPS * LANES] for p in parts]) if parts else np.zeros(0, np.int32)
        ids = table.ids[sym[:b["n_tokens"]]]
        if zlib.crc32(ids.astype("<u4").tobytes()) != b["ids_crc32"]:
            raise ValueError("a block's ids do not match their checksum")
        out.append(ids)
    return out


def crc32_combine(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from the (crc, bytes) of its parts.

    Appending ``n`` zero bytes to a message is a linear map on its CRC; the
    map for one zero bit is squared up to the wanted length.
    """
    def apply(matrix: list[int], v: int) -> int:
        out, k = 0, 0
        while v:
            if v & 1:
                out ^= matrix[k]
            v >>= 1
            k += 1
        return out

    total = 0
    for crc, n in parts:
        step = [0xEDB88320] + [1 << k for k in range(31)]     # one zero bit (fixed value: the CRC-32 polynomial)
        bits = n * 8
        while bits:
            if bits & 1:
                total = apply(step, total)
            step = [apply(step, v) for v in step]
            bits >>= 1
        total ^= crc
    return total
