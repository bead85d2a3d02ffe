"""Hashes of words and of runs of words, over the UTF-8 bytes of one text at a time."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]  # A-Z hash as a-z
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of the base and of its inverse, as long as the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 14)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE)])
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, _INVERSE)])
        return self.up, self.down


_powers = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _rolled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    up, down = _powers.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def words(data: bytes, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (in bytes) of the words of a text, A-Z taken as a-z. Words are
    runs of bytes outside `breaks`, by default ASCII white space."""
    b = np.frombuffer(data, np.uint8)
    gap = np.ones(len(b) + 2, bool)
    gap[1:-1] = breaks[b]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    return mixed(_rolled(b, starts, ends) + (ends - starts).astype(np.uint64) * _STEP), starts, ends


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _STEP + hashes[i : i + n]
    return mixed(out)


def shingles(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingles of a text: runs of `size` words; of a shorter text its whole
    sequence is one; of a text without words there are none."""
    h = words(data)[0]
    if not len(h):
        return h
    return np.unique(runs(h, min(size, len(h))))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` bytes, cases told apart."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return mixed(_rolled(data, at, at + size, _EXACT))


_EXACT = _rng.integers(1, 2**63, 256, dtype=np.uint64)
