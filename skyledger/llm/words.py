"""Words of UTF-8 texts, hashed a block at a time."""

from __future__ import annotations

import numpy as np

from skyledger.llm.common import GOLDEN, mix64

#: White space: tab to carriage return, and the blank.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: A value for each byte, by rule; texts are polynomials in BASE over them.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

#: Likewise for each byte at each of the first places of a word.
PLACES = 64
_PLACED = mix64(np.arange(1, PLACES * 256 + 1, dtype=np.uint64) * GOLDEN)

_powers = {True: np.ones(1, dtype=np.uint64), False: np.ones(1, dtype=np.uint64)}


def powers(inverse: bool, n: int) -> np.ndarray:
    """The first ``n`` powers of BASE, or of its inverse, modulo 2**64."""
    if len(_powers[inverse]) < n:
        grown = np.full(max(n, 1 << 18), _INVERSE if inverse else BASE, dtype=np.uint64)
        grown[0] = 1
        _powers[inverse] = np.cumprod(grown)
    return _powers[inverse][:n]


def prefix_values(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the values as coefficients of a polynomial in BASE: of two of them
    the difference, brought back to place 0, is a value of what stands between."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(False, len(values)), out=sums[1:])
    return sums


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin, where they end (past the last byte), and the rows' offsets
    among them. A word is a run of bytes that are no white space, within one row."""
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    inside = ~SPACE[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word; equal words have equal values wherever they stand.

    The sum of values drawn by rule for each byte at its place: no two texts of a pattern
    are bound to meet, as they are for polynomials modulo a power of two.
    """
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    inside = data[place + np.repeat(starts, sizes)].astype(np.int64)
    far = np.flatnonzero(place >= PLACES)
    value = _PLACED[(place % PLACES) * 256 + inside]
    value[far] = mix64(value[far] + (place[far] // PLACES).astype(np.uint64) * GOLDEN)
    sums = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value, out=sums[1:])
    return mix64(sums[begin + sizes] - sums[begin] + sizes.astype(np.uint64) * GOLDEN)
