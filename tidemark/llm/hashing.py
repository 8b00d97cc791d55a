"""Word and shingle hashes of whole batches of texts, in numpy.

A word is a run of bytes other than space, tab, line ends and the like; A-Z count as a-z. Its hash is a
polynomial in an odd base over random byte codes, mod 2^64, and then mixed: sums over words of one
array do for all texts of a batch at once. The codes are drawn from a fixed seed, so all tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.array([32, 9, 10, 11, 12, 13])
_SOLID = np.ones(256, bool)
_SOLID[_SPACE] = False
_CODES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]
_CODES[_SPACE] = 0
_powers: list[np.ndarray] = []


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], done = 1, 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 19)
        _powers[:] = [_geometric(_BASE, size), _geometric(pow(_BASE, -1, 2**64), size)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(texts: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts, in order, about `size` bytes at a time: first row, end row, bytes, bounds of the rows."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, in order, and how many words each text has."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    solid = _SOLID[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    up, down = powers(len(data))
    sums = np.add.reduceat(_CODES[data] * up, starts)
    return mix(sums * down[starts]), np.diff(np.searchsorted(starts, bounds))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the distinct runs of `width` words of one text, sorted; of all words, if there are fewer."""
    if not len(words):
        return words
    size = min(width, len(words))
    out = words[: len(words) - size + 1] + np.uint64(size)
    for k in range(1, size):
        out = mix(out * np.uint64(_BASE) + words[k : len(words) - size + 1 + k])
    return np.unique(mix(out))
