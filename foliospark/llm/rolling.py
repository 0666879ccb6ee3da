"""Hashes of all substrings of a block of bytes by one prefix sum, with numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
LETTER = _RNG.integers(0, 1 << 64, 256, np.uint64)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((BASE, INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Prefix:
    """hash(a, b) of bytes [a, b) doesn't depend on where they stand."""

    def __init__(self, flat: np.ndarray, letter: np.ndarray = LETTER):
        power, self.inverse = _powers(len(flat) + 1)
        self.sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(letter[flat] * power[:-1], out=self.sums[1:])

    def hash(self, a, b) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.inverse[a])

    def fixed(self, n: int) -> np.ndarray:
        """hash(p, p + n) for every p."""
        d = self.sums[n:] - self.sums[: len(self.sums) - n]
        return mix(d * self.inverse[: len(d)])


def sliding(op, x: np.ndarray, n: int) -> np.ndarray:
    """op (np.minimum, np.maximum) over every window of n values, by doubling."""
    out, have = x, 1
    while have * 2 <= n:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(x) - n + 1], out[n - have : n - have + len(x) - n + 1]) if have < n else out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def point_offsets(flat: np.ndarray) -> np.ndarray:
    """Code points before each byte of UTF-8, and at the end."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum((flat & 0xC0) != 0x80)])


def labels(n: int, a: np.ndarray, b: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each of n nodes' component under the links a-b, beside those that start already has."""
    lab = np.arange(n) if start is None else start
    while True:
        x, y = lab[a], lab[b]
        differ = x != y
        if not differ.any():
            return lab
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up


def pairs_of(counts_a: np.ndarray, first_a: np.ndarray, counts_b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (i, j) with i in a's and j in b's range, for each entry: (entry, i, j)."""
    total = counts_a * counts_b
    entry = np.repeat(np.arange(len(total)), total)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(total) - total, total)
    return entry, first_a[entry] + within // counts_b[entry], first_b[entry] + within % counts_b[entry]
