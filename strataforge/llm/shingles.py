"""64-bit hashes of words and word shingles, in numpy, the same on every executor."""

from __future__ import annotations

import numpy as np

from .common import LOWER_TABLE

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(5).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Keeps the powers that the rolling hash needs, as long as the longest text so far."""

    def __init__(self) -> None:
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        powers = np.full(n, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(n, pow(_BASE, -1, 2**64), np.uint64)
        inverse[0] = 1
        self.powers, self.inverse = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if n >= len(self.powers):
            self._grow(2 * n + 2)

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        """Sums up to each byte, from which `between` gets the hash of any stretch."""
        self.reach(len(raw))
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.powers[: len(raw)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.inverse[start]

    def words(self, text: bytes) -> np.ndarray:
        """Hashes of the words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, in order."""
        raw = np.frombuffer(text.translate(LOWER_TABLE), np.uint8)
        edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).view(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        return mix(self.between(self.prefix(raw), start, end))

    @staticmethod
    def shingles(words: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all runs of `size` words, in order; of the whole sequence where it is shorter; of none for no word."""
        if not len(words):
            return words
        n = min(size, len(words))
        total = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            total += words[k : k + len(total)] * _PLACES[k % 64]
        return mix(total)
