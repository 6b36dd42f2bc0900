"""Words of texts as 64-bit hashes, with array operations over whole batches.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Its hash is a polynomial over random byte
values modulo 2^64, finished by a mixing step; equal words have equal hashes everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes whose hashes are summed at once; a longer word is hashed alone.
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _spaces() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t[data]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text begins and ends in them; null is empty."""
    col = pa.compute.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the first word of each text (with one more entry at the end)."""
    solid = ~_spaces()[data]
    n = len(data)
    first = np.empty(n, bool)
    last = np.empty(n, bool)
    if n:
        first[0], last[-1] = True, True
        np.logical_not(solid[:-1], out=first[1:])
        np.logical_not(solid[1:], out=last[:-1])
        inner = offsets[(offsets > 0) & (offsets < n)]
        first[inner], last[inner - 1] = True, True
    starts = np.flatnonzero(solid & first)
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word."""
    out = np.empty(len(starts), np.uint64)
    values, at = _byte_values(), 0
    size = int(min(len(data), max(_BLOCK, (ends - starts).max() if len(starts) else 0)))
    up, down = _powers(_BASE, size), _powers(_INVERSE, size)
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
        part = data[base : ends[to - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], dtype=np.uint64, out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        at = to
    return mix(out)


def words(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each text (one more entry)."""
    data, offsets = text_bytes(col)
    if lower:
        data = lowered(data)
    starts, ends, first = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), first


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, those that cross texts included."""
    m = max(0, len(hashes) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + m])
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word runs of each text; a shorter text counts whole as one
    run, a text without words has none."""
    runs = sequences(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            out.append(sequences(hashes[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
