"""Hashed word shingles of whole texts, with numpy."""

from __future__ import annotations

import numpy as np

# ASCII white space, and odd multipliers that mix 64-bit numbers.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
M1, M2, M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
STEP = 0x2545F4914F6CDD1D
SLICE = 1 << 20

_BYTE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the step and of its inverse, as far as they have been asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            n = max(n, 4096, 2 * len(self.up))
            inverse = pow(STEP, -1, 2**64)
            both = []
            for base in (STEP, inverse):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
            self.up, self.down = both
        return self.up, self.down


_powers = _Powers()


def _hashes(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    up, down = _powers.upto(len(data) + 1)
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * M1)


def word_hashes(text: str) -> np.ndarray:
    """A hash of every word in order; long texts go slice by slice, cut at white space."""
    raw = text.encode().translate(LOWERED)
    if len(raw) <= SLICE:
        return _hashes(raw)
    found, start = [], 0
    while start < len(raw):
        stop = min(len(raw), start + SLICE)
        while stop < len(raw) and not SPACE[raw[stop]]:
            stop += 1
        found.append(_hashes(raw[start:stop]))
        start = stop
    return np.concatenate(found)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of a shorter text, of all its words as one."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total * M1 + words[i : len(words) - n + 1 + i])
    total.sort()
    first = np.ones(len(total), bool)
    np.not_equal(total[1:], total[:-1], out=first[1:])
    return total[first]
