"""Hashes of all words of a text at once, without making the words."""

from __future__ import annotations

import numpy as np


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def factors(n: int, salt: int = 0) -> np.ndarray:
    """An odd factor for each place. Places have factors that do not depend on each other, unlike the powers of one number, of which
    certain orders of two letters have equal sums whatever the number."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 40)) | np.uint64(1)


def spans(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs outside the gaps."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed sum of the bytes of each word, each times the factor of its place."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)  # place of each byte in its word
    values = factors(int(lengths.max()))[at]
    values *= data[at + np.repeat(starts.astype(np.int32), lengths)] + np.uint64(1)
    return mixed(np.add.reduceat(values, first))


def equal_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, other: np.ndarray, other_starts: np.ndarray) -> bool:
    """Whether all runs of bytes equal their counterparts in `other`."""
    total = int(lengths.sum())
    at = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return bool((data[at + np.repeat(starts, lengths)] == other[at + np.repeat(other_starts, lengths)]).all())
