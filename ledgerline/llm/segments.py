"""Vectorised helpers over batches of texts: code points, segments and their hashes.

All functions take whole texts; a null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: An odd multiplier, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def slices(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths add up to ``most`` at most; a longer row stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def code_points(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in a row, and the offset at which each text starts (and the last ends)."""
    texts = [t or "" for t in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _powers[k] = np.multiply.accumulate(full)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment ``values[start:end]``; equal segments have equal hashes in any process."""
    power, inverse = _power(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=total[1:])
    raw = (total[ends] - total[starts]) * inverse[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


#: The six ASCII white space characters: tab to carriage return, and space.
def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def words(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of characters other than ASCII white space, and each text's number of runs."""
    solid = np.zeros(len(points) + 1, bool)
    solid[:-1] = ~is_space(points)
    before = np.zeros(len(points) + 1, bool)
    before[1:] = solid[:-1]
    before[offsets] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(points) + 1, bool)
    after[:-1] = solid[1:]
    inner = offsets[1:][offsets[1:] > 0] - 1
    after[inner] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each of several ranges, in a row."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - at, counts)
