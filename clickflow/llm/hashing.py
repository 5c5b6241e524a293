"""Vectorised 64-bit hashing of words, word runs and byte windows inside a buffer of texts."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240131))
_ODD = lambda: np.uint64(int(_RNG.integers(0, 1 << 63)) * 2 + 1)
#: One random value for each byte; ``FOLDED`` gives A-Z those of a-z.
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED = BYTE.copy()
FOLDED[65:91] = BYTE[97:123]
BASE = _ODD()
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEPS = np.array([_ODD() for _ in range(16)], np.uint64)
#: Space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i modulo 2**64 for i < n (kept and grown)."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, step in (("up", BASE), ("down", INVERSE)):
            run = np.full(size, step, np.uint64)
            run[0] = 1
            _POWERS[name] = np.multiply.accumulate(run)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text the index of its first word (one more at the end)."""
    solid = ~space[buf]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(buf)]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    edge = offsets[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
    """A hash for each byte run [start, end): equal runs have equal hashes wherever they stand."""
    up, down = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * down[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64) * STEPS[0])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of k words; the whole sequence as one if there are fewer."""
    if not len(words):
        return words
    n = max(len(words) - k + 1, 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        total += words[i : i + n] * STEPS[i + 1]
    return np.unique(mix(total + np.uint64(min(k, len(words)))))
