"""Vectorised hashes of byte buffers and word sequences, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes that separate words: space and U+0009 to U+000D.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# A fixed random 64-bit value for each byte.
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_kept: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """The first powers of ``base``, n at least; one table of each base is kept."""
    if len(_kept.get(base, ())) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _kept[base] = np.multiply.accumulate(out)
    return _kept[base]


def _sized(n: int) -> int:
    """Length of the table for ``n`` bytes: a few lengths only, as a longer table is made anew, and little above ``n``."""
    return ((n >> 20) + 1) << 20 if n >= 1 << 20 else 1 << max(16, (n + 1).bit_length())


class Prefix:
    """Prefix polynomial hashes of a byte buffer, modulo 2**64: any substring's hash in one step."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        # In place: the arrays are eight times as large as the text.
        terms = self.sums[1:]
        np.take(_BYTES, data, out=terms, mode="clip")
        terms *= _powers(_sized(n), _BASE)[:n]
        np.cumsum(terms, out=terms)
        self.back = _powers(_sized(n), _INVERSE)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def grams(self, length: int) -> np.ndarray:
        """Hash of every substring of this length, by start."""
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.back[:n]


class Words:
    """The words of several texts as one buffer in which single spaces separate them.

    ``start`` and ``end`` are positions in ``data``; ``first`` holds the number
    of each text's first word, with the total at its end.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            raw = LOWER[raw]
        space = SPACES[raw]
        after = np.empty_like(space)
        after[0] = True
        after[1:] = space[:-1]
        kept = ~(space & after)  # the first separator behind each word stays
        begins = np.flatnonzero(~space & after)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(begins, offsets)
        self.data = np.where(space, np.uint8(32), raw)[kept]
        ends = np.flatnonzero(self.data == 32)
        self.end = ends
        self.start = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return mix(Prefix(self.data).of(self.start, self.end) + (self.end - self.start).astype(np.uint64))

    def of_text(self) -> np.ndarray:
        """Number of the text that each word is of."""
        return np.repeat(np.arange(len(self.count)), self.count)


def sequences(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` word hashes, by start."""
    n = max(0, len(words) - length + 1)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out *= np.uint64(_BASE)
        out += words[i : i + n]
    return mix(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by start, in a few passes whatever the width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
