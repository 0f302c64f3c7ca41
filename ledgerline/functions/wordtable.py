"""Search for all terms of a large dictionary in one pass over each text: windows of bytes looked up by their hashes.

The table grows with the bytes of its terms, some 10 bytes for one. A position is looked at further where its first eight
bytes (or fewer, for shorter terms) begin a term; for each length of terms the whole window is then hashed, looked up, and
compared byte by byte. ``starts`` answers as ``functions.automaton.Automaton`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

#: Bits of the filter's table for each key, and the largest table (a byte an entry).
ROOM, MOST_ENTRIES = 8, 1 << 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Stands between texts and after the last one; no byte of UTF-8.
GAP = b"\xff"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes from each place on, as a number; ``data`` ends with eight bytes more."""
    return np.ndarray((len(data) - 8,), ">u8", data, 0, (1,)).astype(np.uint64)


class _Filter:
    """Says of keys whether they may be among the table's: no for most others."""

    def __init__(self, keys: np.ndarray):
        bits = min(max(8, int(len(keys) * ROOM).bit_length()), MOST_ENTRIES.bit_length() - 1)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(keys * _ODD) >> self.shift] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self.table[(keys * _ODD) >> self.shift]


class _Length:
    """The terms of one length in bytes, by the hashes of their windows."""

    def __init__(self, size: int, terms: np.ndarray, begins: np.ndarray, eights: np.ndarray):
        self.size = size
        #: Where a term's windows of eight bytes begin; the last one may overlap the one before.
        self.at = [*range(0, size - 8, 8), size - 8] if size > 8 else [0]
        self.cut = np.uint64(8 * max(0, 8 - size))
        for seed in range(64):
            self.seed = np.uint64(seed)
            found = self._hash(begins, eights)
            order = np.argsort(found)
            self.hashes = found[order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():  # terms are distinct, so another seed sets them apart
                break
        else:
            raise ValueError(f"terms of {size} bytes share their hashes")
        self.terms, self.begins = terms[order], begins[order]

    def _window(self, places: np.ndarray, eights: np.ndarray, i: int) -> np.ndarray:
        return eights[places + self.at[i]] >> self.cut

    def _hash(self, places: np.ndarray, eights: np.ndarray) -> np.ndarray:
        out = np.full(len(places), self.seed * _ODD)
        for i in range(len(self.at)):
            out = _mixed((out ^ self._window(places, eights, i)) * _ODD)
        return out

    def find(self, places: np.ndarray, eights: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, term) where a term stands; ``own`` are the terms' eights."""
        wanted = self._hash(places, eights)
        slot = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        same = self.hashes[slot] == wanted
        places, slot = places[same], slot[same]
        for i in range(len(self.at)):
            same = self._window(places, eights, i) == self._window(self.begins[slot], own, i)
            places, slot = places[same], slot[same]
        return places, self.terms[slot]


class WordTable:
    """Finds where terms (not empty, each once) start; ``nbytes`` is the table's size."""

    def __init__(self, terms: pa.Array | Sequence[str]):
        terms = pa.array(terms, pa.large_string()) if not isinstance(terms, pa.Array) else terms.cast(pa.large_string())
        ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
        data = terms.buffers()[2].to_pybytes()[int(ends[0]) : int(ends[-1])] if len(terms) else b""
        begins, self.lengths = ends[:-1] - ends[:1] if len(terms) else np.zeros(0, np.int64), np.diff(ends).astype(np.int64)
        self.eights = _eights(data + GAP * 8)
        order = np.argsort(self.lengths, kind="stable")
        sizes, firsts = np.unique(self.lengths[order], return_index=True)
        self.own = [_Length(int(n), order[a:b], begins[order[a:b]], self.eights) for n, a, b in zip(sizes, firsts, [*firsts[1:], len(order)])]
        #: For each length of keys, 8 at most: the filter, the keys, the lengths that begin with each (as bits, so that one
        #: in 64 may stand for another), and the lengths.
        self.keys = []
        for n in sorted({min(x.size, 8) for x in self.own}):
            mine = [x for x in self.own if min(x.size, 8) == n]
            cut = np.uint64(8 * (8 - n))
            keys, at = np.unique(np.concatenate([self.eights[x.begins] >> cut for x in mine]), return_inverse=True)
            bits = np.zeros(len(keys), np.uint64)
            np.bitwise_or.at(bits, at, np.repeat(np.array([1 << (i % 64) for i in range(len(mine))], np.uint64), [len(x.begins) for x in mine]))
            self.keys.append((cut, _Filter(keys), keys, bits, mine))

    @property
    def nbytes(self) -> int:
        return self.eights.nbytes + self.lengths.nbytes + sum(x.hashes.nbytes + x.terms.nbytes + x.begins.nbytes for x in self.own) + sum(f.table.nbytes + k.nbytes + b.nbytes for _, f, k, b, _ in self.keys)

    def starts(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, byte at which an occurrence starts, term) of every occurrence, in no order."""
        if not self.own or not texts:
            return (np.zeros(0, np.int64),) * 3
        eights = _eights(GAP.join(texts) + GAP * 8)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        out = []
        for cut, filter_, keys, bits, lengths in self.keys:
            own = eights >> cut if cut else eights
            places = np.flatnonzero(filter_(own))
            slot = np.minimum(np.searchsorted(keys, own[places]), len(keys) - 1)
            same = keys[slot] == own[places]
            places, said = places[same], bits[slot[same]]
            for i, length in enumerate(lengths):
                mine = places[(said >> np.uint64(i % 64)) & np.uint64(1) == 1]
                mine = mine[mine + length.size <= len(eights)]
                if len(mine):
                    out.append(length.find(mine, eights, self.eights))
        place, term = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
        doc = np.searchsorted(begins, place, "right") - 1
        return doc, place - begins[doc], term.astype(np.int64)
