"""Hashes of words, for many words at a time."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Bytes of a text that are hashed at a time: bounds the memory that a very long text takes.
STRETCH = 1 << 20
_BASE = 0x100000001B3 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n at least."""
    size = 1 << max(12, int(n).bit_length())
    return _powers(_BASE, size), _powers(_INVERSE, size)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    white = _WHITE[data]
    edges = np.diff(np.concatenate([[True], white, [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    forward, back = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * forward[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * back[starts]
    return starts, ends, mixed(hashes + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of UTF-8 bytes, at ASCII white space, ASCII letters lowered."""
    if len(data) <= 2 * STRETCH:
        return _word_hashes(data)
    out, at = [], 0
    while at < len(data):
        stop = at + STRETCH
        while stop < len(data):
            space = np.flatnonzero(_WHITE[data[stop : stop + STRETCH]])
            if len(space):
                stop += int(space[0])
                break
            stop += STRETCH
        starts, ends, hashes = _word_hashes(data[at : min(stop, len(data))])
        out.append((starts + at, ends + at, hashes))
        at = min(stop, len(data))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter; none for no words."""
    n = len(hashes)
    size = min(size, n)
    if not n:
        return hashes
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        out = mixed(out + hashes[k : n - size + 1 + k])
    return out
