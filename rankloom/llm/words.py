"""Words of whole texts as flat NumPy arrays over an Arrow batch.

Texts are handled as UTF-8 bytes. Words are runs of digits, ASCII letters (lower-cased) and
bytes from 0x80 on, which is every non-ASCII character. A word's 64-bit hash comes from one
prefix sum over the bytes, so no Python object is made per word. A null text has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _lower_word_bytes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


WORD_BYTES = _lower_word_bytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its texts begin and end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return raw[first:last], offsets - first


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, (n + 1).bit_length())
    if size not in _POWERS:
        made = []
        for base in (_RADIX, _RADIX_INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        if size > 1 << 20:
            return made[0], made[1]
        _POWERS[size] = (made[0], made[1])
    return _POWERS[size]


def _cut(low: np.ndarray, offsets: np.ndarray, begin: int) -> int:
    """End of the piece from ``begin``: a text's begin or a place between words."""
    end = begin + PIECE
    if end >= len(low):
        return len(low)
    text = int(offsets[np.searchsorted(offsets, end, "right") - 1])
    if text > begin:
        return text
    gaps = np.flatnonzero(low[begin + 1 : end] == 0)
    if gaps.size:
        return begin + 1 + int(gaps[-1])
    stop = int(offsets[np.searchsorted(offsets, end, "right")])
    gaps = np.flatnonzero(low[end:stop] == 0)
    return end + int(gaps[0]) if gaps.size else stop


def find_words(data: np.ndarray, offsets: np.ndarray):
    """(begins, ends, hashes, first): byte places and hash of every word, and for each text the
    index of its first word; ``first`` has one entry more than there are texts."""
    low = WORD_BYTES[data]
    begins, ends, hashes = [], [], []
    at = 0
    while at < len(low):
        stop = _cut(low, offsets, at)
        piece = low[at:stop]
        inside = piece != 0
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "left")] - at
        edges = edges[edges > 0]
        opens[edges] |= inside[edges]
        closes[edges - 1] |= inside[edges - 1]
        b = np.flatnonzero(opens)
        e = np.flatnonzero(closes) + 1
        up, down = _powers(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * up[: len(piece)], dtype=np.uint64, out=sums[1:])
        hashes.append(mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64)))
        begins.append(b + at)
        ends.append(e + at)
        at = stop
    whole = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((begins, np.int64), (ends, np.int64), (hashes, np.uint64))]
    return *whole, np.searchsorted(whole[0], offsets)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, whatever texts they belong to."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out *= np.uint64(_RADIX)
        out += hashes[k : k + count]
    return mix(out)


def words_in(text: bytes) -> list[bytes]:
    """The words of one short text."""
    return bytes(WORD_BYTES[np.frombuffer(text, np.uint8)]).replace(b"\0", b" ").split()


class HashSet:
    """Members among many 64-bit values: a bitmap drops most, a sorted array decides."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        bits = max(16, min(24, int(len(self.values)).bit_length() + 5))
        self.shift = np.uint64(64 - bits)
        self.map = np.zeros(1 << bits, bool)
        self.map[(self.values >> self.shift).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``h`` that hold a member, index of that member)."""
        at = np.flatnonzero(self.map[(h >> self.shift).astype(np.int64)])
        if not at.size:
            return at, at
        index = np.minimum(np.searchsorted(self.values, h[at]), len(self.values) - 1)
        same = self.values[index] == h[at]
        return at[same], index[same]
