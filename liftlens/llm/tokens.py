"""Words of a whole Arrow batch of texts as numpy arrays, with 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_RNG = np.random.default_rng(20240101)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BASES = [int(x) * 2 + 1 for x in _RNG.integers(2 ** 40, 2 ** 62, 4)]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over all output bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < 2^bits."""
    out = []
    for b in (base, pow(base, -1, 2 ** 64)):
        p = np.full(1 << bits, _U(b))
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


CHUNK_BITS = 19


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int,
               table: np.ndarray | None = None) -> np.ndarray:
    """Hash of values[start:end] (of table[values] if given) for sorted ranges.

    Prefix sums of values[i] * base^i give every range's polynomial; they are taken over
    pieces of 2^CHUNK_BITS values, so memory follows the piece and not the text.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + (1 << CHUNK_BITS), "right")))
        high = int(ends[j - 1])
        piece = values[low:high] if table is None else table[values[low:high]]
        # only a range longer than a piece needs more powers than a piece has
        up, down = _powers(BASES[lane], max(CHUNK_BITS, (high - low).bit_length()))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(piece * up[:high - low], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


class Words:
    """Runs without white space (space, \\x09-\\x0D) of every text of an Arrow string array.

    ``start`` and ``end`` are byte positions in ``data``; the words of text d are
    ``first[d]:first[d + 1]``.  Nulls count as empty.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.string())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        self.data = data[offsets[0]:offsets[-1]]
        self.bounds = offsets - offsets[0]
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = ~((self.data == 32) | ((self.data >= 9) & (self.data <= 13)))
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.bounds] = True
        here = inside[1:-1]
        self.start = np.flatnonzero(here & (cut[:-1] | ~inside[:-2]))
        self.end = np.flatnonzero(here & (cut[1:] | ~inside[2:])) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    def hashes(self) -> np.ndarray:
        return range_hash(self.data, self.start, self.end, 0, _BYTE)

    def texts(self, keep: np.ndarray) -> list[bytes]:
        """Of every text, its words where ``keep`` holds, joined by one space."""
        raw = self.data.tobytes()
        out = []
        spans = list(zip(self.start.tolist(), self.end.tolist()))
        flags = keep.tolist()
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            out.append(b" ".join([raw[s:e] for (s, e), k in zip(spans[a:b], flags[a:b]) if k]))
        return out
