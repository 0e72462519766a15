"""Vectorised 64-bit hashes of the words of whole texts, on byte arrays."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)      # fixed values of the splitmix64 mixer
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x2545F4914F6CDD1D                # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(256, dtype=np.uint64))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of [a, b) is ``span_hash(sums, a, b)``."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power(_BASE, len(codes)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the spans [a, b), the same wherever the span stands."""
    return (sums[b] - sums[a]) * _power(_INVERSE, len(sums))[a]


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """Words of the rows ``raw[offsets[i]:offsets[i+1]]``: hashes, starts, ends, and word bounds per row."""
    if len(raw) == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    sums = prefix_sums(BYTE_CODES[LOWER[raw] if lower else raw])
    hashes = mix(span_hash(sums, starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbouring items (rows are not regarded)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = mix(out) + hashes[j:n + j]
    return mix(out)
