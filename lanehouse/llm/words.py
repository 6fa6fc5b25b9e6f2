"""Words of many UTF-8 texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: byte tables: white space (space, tab to carriage return), and ASCII letters in lower case
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _ODD, dtype=np.uint64)
    down = np.full(size, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(21, (size + 1).bit_length()))
    return up[: size + 1], down[: size + 1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per byte span; equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE):
    """Start, end and text number of every word: a longest run of bytes that are not white space.

    ``bounds`` are the offsets of the texts; a word ends where its text does.
    """
    inside = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = np.zeros(len(data) + 1, dtype=bool)
    closes[1:] = inside
    closes[:-1] &= ~inside
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins[inner] = inside[inner]
    closes[inner] = inside[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def words_of(data: np.ndarray, bounds: np.ndarray, lower: bool = True):
    """Hash and text number of every word, in order; ASCII letters in lower case if ``lower``."""
    if lower:
        data = LOWER[data]
    starts, ends, text = word_spans(data, bounds)
    return span_hashes(data, starts, ends), text
