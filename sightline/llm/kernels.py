"""Vectorised byte work on texts: folding, hashing of grams, words and windows.

All hashes are 64 bits, from fixed tables, so they agree between processes.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_TABLE = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
# A-Z to a-z, nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs."""
    return mix(a * U(0x9E3779B97F4A7C15) + (b ^ (b >> U(29))) + U(0x632BE59BD9B4E019))


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from every position, by doubling run lengths."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    run, length = _TABLE[data], 1
    while 2 * length <= n:
        run = pair(run[:-length], run[length:])
        length *= 2
    if length < n:
        run = pair(run[: len(data) - n + 1], run[n - length :])
    return run


_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers = tuple(np.cumprod(np.concatenate([[U(1)], np.full(size, b)]), dtype=np.uint64) for b in (_BASE, _INVERSE))
    return _powers


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every word, words being runs of bytes that are no ASCII white space."""
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACES[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * powers[: len(data)], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * U(0xA24BAED4963EE407))


def shingles(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words, A-Z lower-cased.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    found = word_hashes(LOWER[np.frombuffer(text.encode(), np.uint8)])
    if not len(found):
        return found
    if len(found) < n:
        run = U(len(found))
        for h in found:
            run = pair(np.array([run]), np.array([h]))[0]
        return np.array([run], np.uint64)
    run = found[: len(found) - n + 1]
    for j in range(1, n):
        run = pair(run, found[j : len(found) - n + 1 + j])
    return np.unique(run)


class Spans:
    """Hashes of any stretches of one text, from prefix sums over powers of a fixed base."""

    def __init__(self, data: np.ndarray):
        self.powers, self.inverses = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.powers[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def every(self, n: int) -> np.ndarray:
        """Hash of the ``n`` bytes from every position."""
        count = max(0, len(self.sums) - n)
        return mix((self.sums[n : n + count] - self.sums[:count]) * self.inverses[:count])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))
