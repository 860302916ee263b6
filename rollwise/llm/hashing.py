"""64-bit hashes of words and byte windows, vectorised over a buffer of UTF-8 text.

A hash of bytes [s, e) comes from prefix sums of value * base^position (mod 2^64), shifted
to a common position, and is then mixed; equal strings have equal hashes wherever they
are. Two different strings agree with a probability of about 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)

_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """base^0 ... base^(n-1); the table grows by doubling and stays with the process."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _BASE)])
    return _powers


class Prefix:
    """Hashes of any ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.power = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.power[: self.n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.power[self.n - start]
        # buffers differ in length: bring every hash to the same power, and add its length
        size = (end - start).astype(np.uint64)
        return mix(raw * _inverse_power(self.n) + np.uint64(0xD6E8FEB86659FD93) * size)

    def windows(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from every position."""
        raw = (self.sums[width:] - self.sums[:-width]) * self.power[self.n - width :: -1][: self.n - width + 1]
        return mix(raw * _inverse_power(self.n - width))


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(pow(int(_BASE), -1, 1 << 64), n, 1 << 64))


def words(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space, A-Z lowered) of the texts, and
    the number of words of each text."""
    data = _LOWER[np.frombuffer(b" ".join([*blobs, b""]), np.uint8)]  # a blank after each text
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(blobs), np.int64)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    raw = Prefix(data)
    hashed = raw.ranges(start, end)
    stops = np.cumsum([len(b) + 1 for b in blobs])
    upto = np.searchsorted(start, stops)
    return hashed, np.diff(upto, prepend=0)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of an ordered sequence of hashes (arrays of equal length)."""
    out = np.full(len(parts[0]), 0x2545F4914F6CDD1D, np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + p)
    return out


def shingle_sets(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; with fewer words the whole
    sequence is one, without words there is none."""
    hashed, counts = words(blobs)
    n = max(0, len(hashed) - width + 1)
    grams = combine([hashed[j : j + n] for j in range(width)]) if n else np.zeros(0, np.uint64)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(grams[at : at + c - width + 1]))
        elif c:
            out.append(combine([np.array([c], np.uint64), *(hashed[at + j : at + j + 1] for j in range(c))]))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out
