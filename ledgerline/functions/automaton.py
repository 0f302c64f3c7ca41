"""Search for all terms of a dictionary in one pass over each text: a trie with failure links (Aho and Corasick, 1975).

The trie is over UTF-8 bytes. A state's row says the next state for each class of bytes, failures already followed, so a
step is one look-up. Texts are cut into pieces that overlap by the longest term; all pieces of a batch take their next step
together, as one array operation.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np

PIECE = 1024


class Automaton:
    """Finds where terms (not empty, each once) start; ``rows`` is the table of next states, ``nbytes`` its size."""

    def __init__(self, terms: Sequence[str]):
        raw = [t.encode() for t in terms]
        self.lengths = np.array([len(t) for t in raw], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        used = sorted(set(b"".join(raw)))
        self.classes = np.zeros(256, np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for i, term in enumerate(raw):
            at = 0
            for c in self.classes[np.frombuffer(term, np.uint8)].tolist():
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][c]
            ends[at] = i
        self.width = len(used) + 1
        self.rows = np.zeros((len(children), self.width), np.int32)
        self.term = np.array(ends, np.int32)
        #: The next state on the chain of failures where a term ends; 0 for none.
        self.also = np.zeros(len(children), np.int32)
        fails = [0] * len(children)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            if at:
                self.rows[at] = self.rows[fails[at]]
                self.also[at] = fails[at] if ends[fails[at]] >= 0 else self.also[fails[at]]
            for c, child in children[at].items():
                fails[child] = int(self.rows[fails[at], c]) if at else 0
                queue.append(child)
            for c, child in children[at].items():
                self.rows[at, c] = child
        self.hit = (self.term >= 0) | (self.also > 0)

    @property
    def nbytes(self) -> int:
        return self.rows.nbytes

    def starts(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, byte at which an occurrence starts, term) of every occurrence, in no order."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        size = max(PIECE, 4 * self.longest)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        n = -(-(ends - begins) // size)
        owner = np.repeat(np.arange(len(texts)), n)
        first = begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * size
        reach = np.minimum(first + size + self.longest - 1, ends[owner]) - first
        order = np.argsort(-reach, kind="stable")
        owner, first, reach = owner[order], first[order], reach[order]
        active = np.searchsorted(-reach, -np.arange(1, int(reach.max(initial=0)) + 1), "right")
        flat, kinds, state = self.rows.ravel(), self.classes[data], np.zeros(len(first), np.int64)
        found = []
        for step, k in enumerate(active.tolist()):
            state[:k] = flat[state[:k] * self.width + kinds[first[:k] + step]]
            hits = np.flatnonzero(self.hit[state[:k]])
            if len(hits):
                found.append((hits, np.full(len(hits), step), state[hits]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        piece, step, at = (np.concatenate(x) for x in zip(*found))
        out = []
        while len(piece):
            term = self.term[at]
            own = term >= 0
            offset = step[own] + 1 - self.lengths[term[own]]
            mine = offset < size  # the next piece finds the others
            out.append((piece[own][mine], offset[mine], term[own][mine]))
            at = self.also[at]
            more = at > 0
            piece, step, at = piece[more], step[more], at[more]
        piece, offset, term = (np.concatenate(x) for x in zip(*out))
        return owner[piece], first[piece] + offset - begins[owner[piece]], term.astype(np.int64)
