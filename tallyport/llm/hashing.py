"""Hashes of words, shingles and sets of many texts at once, over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, BASE, np.uint64))])
    return _powers[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each range [start, end) of bytes; ranges are ascending and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    inside = at < np.repeat(np.concatenate([[0], lengths]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    at = np.where(inside, at, 0)
    terms = BYTE_VALUE[data] * powers(int(lengths.max()) + 1)[at]
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * GOLDEN)


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and for each text where its words begin (one more at the end).

    Words are runs of anything but ASCII white space; A to Z are lower-cased.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    if lower:
        data = LOWER[data]
    space = SPACE[data]
    edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    text_starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    return segment_hashes(data, starts, ends), np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than `size` make one shingle."""
    words, bounds = word_hashes(texts)
    rolled = words.copy()
    for i in range(1, size):
        if len(words) > i:
            rolled[:-i] = mix(rolled[:-i] * GOLDEN + words[i:])
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            one = words[a : a + 1]
            for i in range(a + 1, b):
                one = mix(one * GOLDEN + words[i : i + 1])
            yield one + np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """A row of `count` minima for each set, none of which may be empty."""
    joined = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * GOLDEN)
    out = np.empty((len(sets), count), np.uint64)
    for i in range(count):
        values = joined * (seeds[2 * i] | np.uint64(1)) + seeds[2 * i + 1]
        values ^= values >> np.uint64(32)
        values *= MIX_1
        out[:, i] = np.minimum.reduceat(values, starts)
    return out


def set_hash(sorted_set: np.ndarray) -> tuple[int, int]:
    """Two independent hashes that name a set."""
    sums = np.array([mix(sorted_set).sum(dtype=np.uint64), mix(sorted_set * MIX_2 + GOLDEN).sum(dtype=np.uint64)])
    names = mix(sums + np.array([len(sorted_set)], np.uint64) * GOLDEN).astype(np.int64)
    return int(names[0]), int(names[1])
