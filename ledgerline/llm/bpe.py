"""Exact byte-level BPE ids of whole texts, worked out once for each distinct pre-token of a batch.

The pre-token borders of the public pattern are found for all characters of a batch with array operations; equal
pre-tokens (by 64-bit hash) are encoded once by the installed library and kept in a cache of bounded size.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np

from .segments import code_points, hashes, spread

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Unicode's White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The endings that the pre-token pattern splits off after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
END_OF_TEXT = "<|endoftext|>"


def character_classes() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        major = unicodedata.category(chr(i))[0]
        if major == "L":
            kinds[i] = LETTER
        elif major == "N":
            kinds[i] = NUMBER
    kinds[WHITE] = SPACE
    return kinds


def pretoken_starts(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """True where a pre-token of the byte-level pattern starts; pre-tokens are gapless within each text."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = kinds[points]
    before = np.full(n, 9, np.uint8)
    before[1:] = kind[:-1]
    after = np.full(n, 9, np.uint8)
    after[:-1] = kind[1:]
    first = offsets[:-1][np.diff(offsets) > 0]
    before[first] = 9
    after[np.append(first[1:], n) - 1] = 9
    plain = points == 32
    after_plain = np.zeros(n, bool)
    after_plain[1:] = plain[:-1]
    after_plain[first] = False
    white = kind == SPACE
    last_before_solid = white & (after < SPACE)
    starts = np.where(white, last_before_solid | (before != SPACE), (kind != before) & ~after_plain)
    quote = np.flatnonzero((points == 39) & (before != OTHER) & ~after_plain & (after == LETTER))
    if len(quote):
        padded = np.append(points, [0, 0])
        room = np.searchsorted(offsets, quote, side="right")
        left = offsets[room] - quote
        short = np.isin(padded[quote + 1], [ord(c) for c in SHORT_ENDINGS])
        long = (left > 2) & np.logical_or.reduce([(padded[quote + 1] == ord(a)) & (padded[quote + 2] == ord(b)) for a, b in LONG_ENDINGS])
        for found, size in ((short, 2), (long & ~short, 3)):
            at = quote[found]
            starts[at + 1] = False
            rest = at[left[found] > size] + size
            starts[rest[kind[rest] == LETTER]] = True
    return starts


class Encoder:
    """Ids of texts, as the public vocabulary's own library gives them without special tokens added."""

    def __init__(self, json_path: str, ranks_path: str, cached: int = 1_000_000):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        import public_tokenizers

        self._encode = tiktoken.Encoding("ledgerline", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._json_path, self._whole = json_path, None
        self._kinds = character_classes()
        (self._newline,) = self._encode("\n")
        self._most = cached
        self._forget()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offset at which each text's ids start (and the last end)."""
        special = [i for i, t in enumerate(texts) if t and END_OF_TEXT in t]
        if special:
            return self._mixed(texts, set(special))
        points, offsets = code_points(texts)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = np.flatnonzero(pretoken_starts(points, offsets, self._kinds))
        ends = np.append(starts[1:], len(points))
        keys, first, which = np.unique(hashes(points, starts, ends), return_index=True, return_inverse=True)
        slot = np.minimum(np.searchsorted(self._keys, keys), max(len(self._keys) - 1, 0))
        new = self._keys[slot] != keys if len(self._keys) else np.ones(len(keys), bool)
        if new.any():
            if len(self._keys) + int(new.sum()) > self._most:
                self._forget()
                new[:] = True
            self._learn("".join(t or "" for t in texts), keys[new], starts[first[new]], ends[first[new]], self._kinds[points])
            slot = np.searchsorted(self._keys, keys)
        begin, sizes = self._begin[slot], self._size[slot]
        counts = sizes[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self._flat[spread(begin[which], counts)], total[np.searchsorted(starts, offsets)]

    def _forget(self) -> None:
        self._keys, self._begin, self._size, self._flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, text: str, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> None:
        """Encodes distinct pre-tokens. Those of letters, after a space or not, go through one call, a line for each."""
        line = (kind[ends - 1] == LETTER) & ((kind[starts] == LETTER) | ((kind[starts] == SPACE) & (ends - starts > 1)))
        order = np.concatenate([np.flatnonzero(line), np.flatnonzero(~line)])
        spans = list(zip(starts[order].tolist(), ends[order].tolist()))
        lines = int(line.sum())
        joined = np.array(self._encode("".join(text[a:b] + "\n" for a, b in spans[:lines])), np.uint32)
        ends_at = np.flatnonzero(joined == self._newline)
        sizes = np.diff(ends_at, prepend=-1) - 1
        rest = [self._encode(text[a:b]) for a, b in spans[lines:]]
        flat = np.concatenate([joined[joined != self._newline], np.fromiter(chain.from_iterable(rest), np.uint32)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, rest), np.int64, len(rest))])
        begin = len(self._flat) + np.cumsum(sizes) - sizes
        self._flat = np.concatenate([self._flat, flat])
        all_keys = np.concatenate([self._keys, keys[order]])
        by_key = np.argsort(all_keys)
        self._keys, self._begin, self._size = all_keys[by_key], np.concatenate([self._begin, begin])[by_key], np.concatenate([self._size, sizes])[by_key]

    def _mixed(self, texts: list, special: set[int]) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold the special token's string go to the library whole."""
        flat, offsets = self([None if i in special else t for i, t in enumerate(texts)])
        if self._whole is None:  # few texts need it
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json_path)
        parts = [np.array(self._whole.encode(texts[i], add_special_tokens=False).ids, np.uint32) if i in special else flat[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
