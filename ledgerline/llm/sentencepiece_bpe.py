"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut wherever no piece has the two characters side by side, so that no merge can cross the cut. The distinct
parts of a batch that were not met before (a cache of bounded size keeps the others) are joined into one text. Its
suffixes are sorted, every piece of the vocabulary is looked up by binary search, and its range of suffixes gives all
places where it occurs: the edges. Sorted by position, the edges are then relaxed part by part: the best-scored edge that
joins two neighbouring symbols, the leftmost among equals, is taken until none is left, which is what the model's merges
give. Characters without a piece fall back to bytes.

Decoding joins pieces, turns space marks into spaces, drops the one that encoding put in front, and reads runs of byte
pieces as UTF-8 (what is malformed becomes U+FFFD).

Defined results: a null or empty text has no ids and decodes to the empty text; U+2581 in a text reads as a space, as in
the library; a null id stays null; equal rows are encoded once each; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import annotate
from .segments import code_points, hashes, spread

SPACE = "▁"
#: Parts up to this many characters are relaxed together, longer ones one by one with a heap.
TOGETHER = 48
CACHED = 1_000_000
UNKNOWN = " ⁇ "


class Vocabulary:
    """The pieces of a model file: texts, scores, and the ids of bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        of_byte = {i: b for b, i in self.byte.items()}
        decoded = [UNKNOWN.encode() if model.is_unknown(i) else b"" if special[i] else bytes([of_byte[i]]) if i in of_byte else self.piece[i].replace(SPACE, " ").encode() for i in range(n)]
        self.decoded, self.leads = decoded, [not special[i] and self.piece[i].startswith(SPACE) for i in range(n)]
        self.flat, self.widths = np.frombuffer(b"".join(decoded), np.uint8), np.array([len(x) for x in decoded])
        self.begins = np.cumsum(self.widths) - self.widths
        self.is_byte = np.array([i in of_byte for i in range(n)])
        plain = [i for i in range(n) if not special[i] and i not in of_byte]
        self.ids = np.array(plain)
        self.sizes = np.array([len(self.piece[i]) for i in plain])
        self.longest = int(self.sizes.max())
        self.points = np.frombuffer("".join(self.piece[i].ljust(self.longest, "\0") for i in plain).encode("utf-32-le"), np.uint32).reshape(-1, self.longest)
        adjoining = {(a, b) for i in plain for a, b in zip(self.piece[i], self.piece[i][1:])}
        letters = sorted({c for pair in adjoining for c in pair})
        number = {c: i + 1 for i, c in enumerate(letters)}
        self.class_of = np.zeros(0x110000, np.uint16)
        self.class_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joins = np.zeros((len(letters) + 1,) * 2, bool)
        for a, b in adjoining:
            self.joins[number[a], number[b]] = True
        self.score = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.rank = np.unique(self.score, return_inverse=True)[1].astype(np.int64)


def _packed(points: np.ndarray, codes: np.ndarray, depth: int) -> list[np.ndarray]:
    """The next ``depth`` characters of each row or position, as integers in their order: so many to a word as fit."""
    bits = max(1, int(codes.max(initial=1)).bit_length())
    per = 62 // bits
    own = codes[points].astype(np.int64)
    column = (lambda d: own[:, d]) if points.ndim == 2 else (lambda d: np.concatenate([own[d:], np.zeros(min(d, len(own)), np.int64)]))
    out = []
    for start in range(0, depth, per):
        value = np.zeros(len(points), np.int64)
        for d in range(start, start + per):
            value = (value << bits) + (column(d) if d < depth else 0)
        out.append(value)
    return out


def _changes(ordered: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]])


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the number of each value among them."""
    order = np.argsort(values)
    new = _changes(values[order])
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return values[order][new], number


def edges(points: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of all pieces: keys position * (longest + 1) + length in order, and the piece ids."""
    depth = vocabulary.longest
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    seen[0] = False
    codes = np.zeros(0x110000, np.int32)
    codes[seen] = np.arange(1, int(seen.sum()) + 1)
    usable = np.flatnonzero((seen[vocabulary.points] | (vocabulary.points == 0)).all(1))
    sizes, pieces = vocabulary.sizes[usable], vocabulary.points[usable]
    suffix, wanted = _packed(points, codes, depth), _packed(pieces, codes, depth)
    bits = max(1, int(codes.max()).bit_length())
    per = 62 // bits
    order = np.lexsort(suffix[::-1])
    low, high = np.zeros(len(usable), np.int64), np.zeros(len(usable), np.int64)
    prefix = np.zeros(len(points), np.int64)  # number of the group of suffixes, in order, with equal words so far
    inside = np.zeros(len(usable), np.int64)  # the group of each piece; -1 where there is none
    for step, (own, key) in enumerate(zip(suffix, wanted)):
        values, number = _numbered(own)
        raw = prefix * (len(values) + 1) + number[order]
        last = (sizes > step * per) & (sizes <= (step + 1) * per) & (inside >= 0)
        unit = np.int64(1) << ((per * (step + 1) - sizes[last]) * bits)
        base = inside[last] * (len(values) + 1)
        low[last] = np.searchsorted(raw, base + np.searchsorted(values, key[last]))
        high[last] = np.searchsorted(raw, base + np.searchsorted(values, key[last] + unit))
        groups, prefix = raw[_changes(raw)], np.cumsum(_changes(raw)) - 1
        place = np.minimum(np.searchsorted(values, key), len(values) - 1)
        exact = np.where((values[place] == key) & (inside >= 0), inside * (len(values) + 1) + place, -1)
        at = np.minimum(np.searchsorted(groups, exact), len(groups) - 1)
        inside = np.where((groups[at] == exact) & (exact >= 0), at, -1)
    counts = high - low
    at = order[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
    key = at * (depth + 1) + np.repeat(sizes, counts)
    by_place = np.argsort(key)
    return key[by_place], np.repeat(vocabulary.ids[usable], counts)[by_place]


class Encoder:
    def __init__(self, path: str, cached: int = CACHED):
        self.vocabulary, self._most = Vocabulary(path), cached
        self._forget()

    def _forget(self) -> None:
        self._keys, self._begin, self._size, self._flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offset at which each text's ids start (and the last end)."""
        v = self.vocabulary
        points, offsets = code_points([SPACE + t if t else t for t in texts])
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.where(points == 32, np.uint32(ord(SPACE)), points)
        kind = v.class_of[points]
        start = np.ones(len(points), bool)
        start[1:] = ~v.joins[kind[:-1], kind[1:]]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(points))
        keys, first, which = np.unique(hashes(points, starts, ends), return_index=True, return_inverse=True)
        new = ~self._has(keys)
        if new.any():
            if len(self._keys) + int(new.sum()) > self._most:
                self._forget()
                new[:] = True
            self._learn(points, keys[new], starts[first[new]], ends[first[new]])
        slot = np.searchsorted(self._keys, keys)
        counts = self._size[slot][which]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self._flat[spread(self._begin[slot][which], counts)], total[np.searchsorted(starts, offsets)]

    def _has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.zeros(len(keys), bool)
        return self._keys[np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)] == keys

    def _learn(self, points: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Segments new parts, each followed by a zero in the text that is indexed."""
        sizes = ends - starts
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.zeros(offsets[-1], np.uint32)
        text[spread(offsets[:-1], sizes)] = points[spread(starts, sizes)]
        ids = self._segment(text, offsets[:-1], sizes)
        counts = np.array([len(x) for x in ids], np.int64)
        begin = len(self._flat) + np.cumsum(counts) - counts
        self._flat = np.concatenate([self._flat, np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum()))])
        at = np.searchsorted(self._keys, keys)
        self._keys, self._begin, self._size = np.insert(self._keys, at, keys), np.insert(self._begin, at, begin), np.insert(self._size, at, counts)

    def _segment(self, points: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> list[Sequence[int]]:
        key, piece = edges(points, self.vocabulary)
        width = self.vocabulary.longest + 1

        def joined(start: np.ndarray, size: np.ndarray) -> np.ndarray:
            if not len(key):
                return np.full(len(start), -1)
            wanted = np.where(size < width, start * width + size, -1)
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            return np.where(key[at] == wanted, piece[at], -1)

        out: list = [None] * len(sizes)
        for i in np.flatnonzero(sizes > TOGETHER).tolist():
            starts = self._heap(int(offsets[i]), int(sizes[i]), joined)
            out[i] = self._ids(points, starts, int(offsets[i] + sizes[i]), joined(starts, np.diff(np.append(starts, offsets[i] + sizes[i]))))
        together = np.flatnonzero(sizes <= TOGETHER)
        if len(together):
            starts, of_part = self._relax(offsets[together], sizes[together], joined)
            ends = np.append(starts[1:], 0)
            last = np.append(of_part[1:] != of_part[:-1], True)
            ends[last] = (offsets[together] + sizes[together])[of_part[last]]
            ids = joined(starts, ends - starts)
            bounds = np.searchsorted(of_part, np.arange(len(together) + 1)).tolist()
            missing = np.bincount(of_part[ids < 0], minlength=len(together)) > 0
            flat = ids.tolist()
            for k, i in enumerate(together.tolist()):
                a, b = bounds[k], bounds[k + 1]
                out[i] = self._ids(points, starts[a:b], int(ends[b - 1]), ids[a:b]) if missing[k] else flat[a:b]
        return out

    def _relax(self, first: np.ndarray, sizes: np.ndarray, joined) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the symbols of all words: in every round each word takes its best edge."""
        of_word = np.repeat(np.arange(len(sizes)), sizes)
        start = first[of_word] + np.arange(len(of_word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = start + 1
        done_start, done_word = [], []
        while len(start):
            heads = np.flatnonzero(np.concatenate([[True], of_word[1:] != of_word[:-1]]))
            lengths = np.diff(np.append(heads, len(start)))
            inner = np.ones(len(start), bool)
            inner[heads + lengths - 1] = False
            inner = np.flatnonzero(inner)
            pair = np.full(len(start), -1, np.int64)
            pair[inner] = joined(start[inner], end[inner + 1] - start[inner])
            place = np.arange(len(start)) - np.repeat(heads, lengths)
            merit = np.where(pair >= 0, self.vocabulary.rank[pair] * (TOGETHER + 1) + TOGETHER - place, -1)
            most = np.repeat(np.maximum.reduceat(merit, heads), lengths)
            active = most >= 0
            best = np.flatnonzero(active & (merit == most))
            end[best] = end[best + 1]
            done_start.append(start[~active])
            done_word.append(of_word[~active])
            active[best + 1] = False
            start, end, of_word = start[active], end[active], of_word[active]
        all_starts, all_words = np.concatenate(done_start), np.concatenate(done_word)
        order = np.lexsort((all_starts, all_words))
        return all_starts[order], all_words[order]

    def _heap(self, first: int, size: int, joined) -> np.ndarray:
        """Starts of the symbols of one long word."""
        score = self.vocabulary.score
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        end = list(range(1, size + 1))
        alive = [True] * size
        width = self.vocabulary.longest
        spans = [joined(np.arange(first, first + size), np.full(size, n)) for n in range(width + 1)]
        pairs = spans[2][: size - 1]
        queue = [(-score[p], i, i + 2, i + 1) for i, p in enumerate(pairs.tolist()) if p >= 0]
        heapq.heapify(queue)

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < size and end[j] - i <= width and (p := int(spans[end[j] - i][i])) >= 0:
                heapq.heappush(queue, (-score[p], i, end[j], j))

        while queue:
            _, i, to, j = heapq.heappop(queue)
            if alive[i] and j < size and alive[j] and after[i] == j and end[j] == to:
                alive[j], end[i], after[i] = False, to, after[j]
                if after[j] < size:
                    before[after[j]] = i
                offer(i)
                if before[i] >= 0:
                    offer(before[i])
        return first + np.flatnonzero(alive)

    def _ids(self, points: np.ndarray, starts: np.ndarray, end: int, ids: np.ndarray) -> list[int]:
        """Ids of a part's symbols; those without a piece as bytes."""
        out: list[int] = []
        for a, b, i in zip(starts.tolist(), [*starts[1:].tolist(), end], ids.tolist()):
            out += [i] if i >= 0 else [self.vocabulary.byte[x] for c in points[a:b].tolist() for x in chr(c).encode("utf-8", "surrogatepass")]
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of ids in a row, as they are given by offsets."""
        v = self.vocabulary
        sizes = v.widths[ids]
        raw = v.flat[spread(v.begins[ids], sizes)].tobytes()
        at = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
        out = []
        for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
            try:
                text = raw[a:b].decode()
            except UnicodeDecodeError:
                text = self._decode_runs(ids[offsets[i] : offsets[i + 1]].tolist())
            out.append(text[1:] if b > a and v.leads[ids[offsets[i]]] else text)
        return out

    def _decode_runs(self, ids: list[int]) -> str:
        """Every run of byte pieces by itself, for texts with malformed runs."""
        v, parts, held = self.vocabulary, [], b""
        for i in ids:
            if v.is_byte[i]:
                held += v.decoded[i]
                continue
            parts += [_utf8(held), v.decoded[i].decode()]
            held = b""
        return "".join([*parts, _utf8(held)])


def _utf8(raw: bytes) -> str:
    """Bytes as UTF-8; each byte that is no part of a character becomes U+FFFD."""
    out = []
    while raw:
        try:
            return "".join([*out, raw.decode()])
        except UnicodeDecodeError as e:
            out += [raw[: e.start].decode(), "�"]
            raw = raw[e.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its ids."""

    def make():
        own = encoder(path)

        def apply(texts):
            ids, offsets = own(texts)
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))]

        return apply

    return annotate(docs, make, "ids array<int>", [], id_col, text_col)


def decode(ids: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: the text that its ids stand for; null ids are an empty text."""

    def run(batches):
        own = encoder(path)
        for batch in batches:
            rows = [np.array(x.as_py() or [], np.int64) for x in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.decode(np.concatenate([np.zeros(0, np.int64), *rows]), offsets), pa.string())], [id_col, "text"])

    source = ids.select(id_col, ids_col)
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, text string")


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: number and CRC-32 of its ids (little-endian, 32 bits), and whether decoding restores it."""

    def make():
        own = encoder(path)

        def apply(texts):
            ids, offsets = own(texts)
            restored = [d == (t or "").replace(SPACE, " ") for d, t in zip(own.decode(ids, offsets), texts)]
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return [pa.array(np.diff(offsets)), pa.array(crc, pa.int64()), pa.array(restored, pa.bool_())]

        return apply

    return annotate(docs, make, "n_ids long, ids_crc32 long, restored boolean", [], id_col, text_col, most=2_000_000)
