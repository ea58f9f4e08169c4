"""Polynomial hashes of byte strings, for all positions at once with numpy.

Arithmetic is modulo 2^64 with an odd base, whose powers have inverses, so the
hash of any stretch comes from two prefix sums.
"""

from __future__ import annotations

import numpy as np

BASE, MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return have


def prefix(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums of (byte + 1) * base**i; entry i covers the bytes before i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1, base)[0][: len(data)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(29)
    return h


def stretches(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hashes of the stretches [start, end)."""
    return mixed((sums[end] - sums[start]) * powers(len(sums), base)[1][start])


def windows(sums: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Hashes of all stretches of ``width`` bytes."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mixed((sums[width:] - sums[:n]) * powers(len(sums), base)[1][:n])


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def eight(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from any position on, as a number; ``words`` is the data as 64-bit numbers."""
    i, s = at >> 3, ((at & 7) << 3).astype(np.uint64)
    return (words[i] >> s) | ((words[i + 1] << (np.uint64(63) - s)) << np.uint64(1))


def ends(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First eight bytes of stretches, and the last eight of those that are longer; with the size they tell up to 16 bytes exactly."""
    n = end - start
    return eight(words, start) & _MASKS[np.minimum(n, 8)], np.where(n > 8, eight(words, end - 8), np.uint64(0))
