"""Content-defined blocks of windows, which bring equal windows together without a row per window.

A window is ``width`` consecutive units (bytes or words). Its anchor is the gram
in it with the least hash, the leftmost if several tie. Consecutive windows with
the same anchor form a block. Equal windows have equal anchors at equal places,
so they are found among the blocks of one anchor hash, the block's ``key``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from spindlewatch.llm.hashing import window_minima

_PLACE_BITS = 24
PIECE = 1 << 20  # units that are hashed at a time
HOT_BLOCKS = 4_096  # blocks of one key above which the key is split


@dataclass
class Blocks:
    """Parallel arrays. ``start``: unit of the first window, ``windows``: how many,
    ``anchor``: units from ``start`` to the anchor, ``key``: hash of the anchor."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    key: np.ndarray

    @staticmethod
    def of(grams: np.ndarray, gram: int, width: int, text: np.ndarray) -> Blocks:
        """Blocks of one buffer: ``grams`` by start, ``text`` the number of the text of each unit.

        The buffer may hold several texts; windows that cross them are left out.
        """
        size = len(text) - width + 1
        if size <= 0:
            none = np.zeros(0, np.int64)
            return Blocks(none, none, none, none.astype(np.uint64))
        if len(grams) >> _PLACE_BITS:
            raise ValueError("buffer too long")
        high = ~np.uint64((1 << _PLACE_BITS) - 1)
        low = window_minima((grams & high) | np.arange(len(grams), dtype=np.uint64), width - gram + 1)[:size]
        inside = text[:size] == text[width - 1 :]
        new = np.ones(size, bool)
        new[1:] = (low[1:] != low[:-1]) | (inside[1:] != inside[:-1]) | (text[1:size] != text[: size - 1])
        starts = np.flatnonzero(new)
        windows = np.diff(np.append(starts, size))
        kept = inside[starts]
        starts, windows = starts[kept], windows[kept]
        places = (low[starts] & ~high).astype(np.int64)
        return Blocks(starts, windows, places - starts, grams[places])




def parts_of(blocks: int, places: int = 1 << 10) -> tuple[int, int]:
    """How a key with so many different blocks is split: by anchor place, of which a window has ``places``, and beyond that by content.

    A split by content needs one by place, as then a part takes single windows.
    """
    by_place = min(-(-blocks // HOT_BLOCKS), max(2, places))
    return by_place, -(-blocks // (HOT_BLOCKS * by_place))


def pieces(length: int, width: int) -> list[tuple[int, int]]:
    """Ranges [from, to) of a long text which hold each of its windows exactly once."""
    if length <= PIECE:
        return [(0, length)]
    return [(at, min(length, at + PIECE + width - 1)) for at in range(0, length - width + 1, PIECE)]
