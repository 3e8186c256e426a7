"""Numpy helpers that run inside tasks: hashes of words, shingles and byte windows of one text."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1

#: One random 64-bit value per byte, the same everywhere.
BYTE_VALUES = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
OTHER_VALUES = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = []
        for base in (_BASE, inverse):
            p = np.full(size, _U(base & _MASK), dtype=np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """``s`` with ``(s[j] - s[i]) * inverse_power[i]`` the rolling hash of ``data[i:j]``."""
    s = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(len(data))[0], out=s[1:])
    return s


def window_hashes(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scrambled hashes of ``data[start:end]`` from the prefix sums of ``data``."""
    return mix(((s[ends] - s[starts]) * powers(len(s))[1][starts]) ^ ((ends - starts).astype(np.uint64) * _GOLD))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ASCII white space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def lowered(text: str) -> np.ndarray:
    """UTF-8 bytes of ``text`` with A-Z lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of ``data`` (bytes)."""
    starts, ends = word_bounds(data)
    return window_hashes(prefix_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; with fewer words, of the whole sequence."""
    if len(words) == 0:
        return words
    k = min(size, len(words))
    h = np.full(len(words) - k + 1, _U(k), dtype=np.uint64)
    for i in range(k):
        h = h * _U(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i]
    return np.unique(mix(h))
