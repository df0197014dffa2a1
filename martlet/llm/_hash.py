"""64-bit hashes of byte runs and words, over whole pieces in numpy.

A run's hash is the polynomial sum of its bytes in one odd base modulo 2**64,
read off prefix sums, so every run of a piece costs the same; ``mix`` then
spreads it. Equal bytes give equal hashes in every process.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _tables[base] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of the bytes; one more entry than bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=out[1:])
    return out


def run_hashes(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each byte run [first, last), the same wherever it stands."""
    return (prefix[last] - prefix[first]) * powers(_INVERSE, len(prefix))[first]


def scaled(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A number in [0, n) from the upper half of each hash."""
    return ((h >> np.uint64(32)) * n.astype(np.uint64)) >> np.uint64(32)


_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z-folded words ``[^\\x20\\x09-\\x0D]+`` of a piece, and
    for each text the number of words before it (one more at the end)."""
    gap = np.ones(len(data) + 1, dtype=bool)
    np.take(_SPACE, data, out=gap[1:])
    inside = ~gap[1:]
    begins = inside & gap[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = inside[heads]
    stops = np.zeros(len(data) + 1, dtype=bool)
    stops[1:-1] = inside[:-1] & (gap[2:] | begins[1:]) if len(data) > 1 else False
    stops[-1] = len(data) > 0 and inside[-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    raw = run_hashes(prefix_sums(_FOLD[data]), first, last)
    return mix(raw + (last - first).astype(np.uint64) * _ODD[2]), np.searchsorted(first, bounds)


def shingle_sets(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's ``width``-word shingles, and their bounds.

    A text of fewer words has all of them as its one shingle; one without words has none.
    """
    counts = np.diff(at)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    long = counts >= width
    n = max(0, len(words) - width + 1)
    every = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        every = (every + words[j : j + n]) * _ODD[j % 5]
        every ^= every >> np.uint64(29)
    out = np.zeros(bounds[-1], dtype=np.uint64)
    starts = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes) + np.repeat(at[:-1], sizes)
    of_long = np.repeat(long, sizes)
    out[of_long] = every[starts[of_long]]
    for i in np.flatnonzero((counts > 0) & ~long):
        h = np.zeros(1, dtype=np.uint64)
        for j in range(at[i], at[i + 1]):
            h = mix(h + words[j : j + 1], 7)
        out[bounds[i]] = mix(h, 100 + int(counts[i]))[0]
    for i in np.flatnonzero(sizes > 1):
        out[bounds[i] : bounds[i + 1]].sort()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    tight = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(np.bincount(owner[fresh], minlength=len(sizes)), out=tight[1:])
    return out[fresh], tight


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash for each set, whatever the order of its members."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mix(hashes, 3), out=total[1:])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * _ODD[3], 5)
