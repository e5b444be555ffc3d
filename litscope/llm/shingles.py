"""Hashed words and shingles of whole texts, vectorised over their bytes.

A word is a run of bytes other than space and tab to carriage return; ASCII
capitals count as small letters. Words and shingles are 64-bit hashes, so two
different ones in a pair of texts meet with a chance below 1e-12.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones((2, 1), np.uint64)


def _power(n: int) -> np.ndarray:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    global _powers
    if _powers.shape[1] < n:
        factors = np.ones((2, 2 * n), np.uint64)
        factors[:, 1:] = [[_BASE], [_INVERSE]]
        _powers = np.cumprod(factors, axis=1, dtype=np.uint64)
    return _powers[:, :n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for every word of a text, in order; null counts as empty."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of so many adjacent words, in order."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * _STEP + words[i : i + count]
    return mix(total ^ np.uint64(size))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, an empty one none."""
    words = word_hashes(text)
    return distinct(runs(words, min(size, len(words)))) if len(words) else words
