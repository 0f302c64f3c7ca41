"""Language ID with error-correcting output codes.

Every language has a codeword; a binary linear classifier on letter n-grams (orders 1 to 3, hashed) predicts each bit.
A text's n-grams give a margin for each bit; the codeword with the least loss, weighted by how good each bit's
classifier is, wins. The weights, the scale of ``score`` and the limit of ambiguity come from labelled texts that the
classifiers have not seen, cut into pieces of many lengths: ``score`` is the winner's share (softmax of the negative
losses, scaled for the text's number of letters), and a text is ambiguous if its best two codewords lie closer together
than in all but ``FLAGGED`` of the pieces of that length that were told right. Texts in several languages, in a language
that was not learned, and noise fall under it.

Learning draws on a bounded sample of labelled documents: of each language the distinct texts with letters whose hashes
are smallest, whatever their ids: ``SAMPLE_PER_LANGUAGE`` of them at most, ``SAMPLE_ROWS`` and ``SAMPLE_CHARS`` in all (but
one text a language at least). A quarter of them is kept apart from the fit.

Defined results: a null text or one without letters is ``und`` with score 0 and not ambiguous; a null id counts as
not held out; equal rows get equal results; no labelled rows: all texts are ``und``; with one language, all texts with
letters are in it; an empty table gives no rows; other columns are not read by ``identify`` and are kept by
``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import annotate, keep_where, smallest
from .bpe import LETTER, character_classes
from .columns import by_place
from .segments import code_points

SAMPLE_PER_LANGUAGE, SAMPLE_ROWS, SAMPLE_CHARS = 400, 8000, 16_000_000
MOST_LANGUAGES = 256
BUCKETS = 1 << 13
UNDETERMINED = "und"
#: Pieces told right that are called ambiguous all the same; pieces that a length needs for a limit of its own.
FLAGGED, FEWEST_PIECES = 0.005, 40
#: Pieces that count as wrong, at least, when the scale of the score is set.
DOUBT = 0.005
LENGTHS = 12
_STEPS, _SCALE = 30, 12.0
_classes: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _classes:
        _classes.append(character_classes() == LETTER)
    return _classes[0]


def grams(texts: Sequence[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed 1-, 2- and 3-grams at every letter, and each text's number of letters; other characters count as a space."""
    points, offsets = code_points([t.lower() if t else t for t in texts])
    if not len(points):
        return [np.zeros(0, np.int64)] * 3, np.zeros(len(texts), np.int64)
    letter = _letters()[points]
    plain = np.where(letter, points, 32).astype(np.uint32)
    total = np.concatenate([[0], np.cumsum(letter)])
    first = np.zeros(len(points), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    back1 = np.concatenate([[32], plain[:-1]]).astype(np.uint32)
    back1[first] = 32
    back2 = np.concatenate([[32], back1[:-1]]).astype(np.uint32)
    back2[first] = 32
    at = np.flatnonzero(letter)
    one, two, three = plain[at], back1[at], back2[at]
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    a = one * np.uint32(2654435761)
    b = (a ^ two) * np.uint32(2246822519) + np.uint32(1)
    c = (b ^ three) * np.uint32(3266489917) + np.uint32(2)
    return [(x >> shift).astype(np.int64) for x in (a, b, c)], total[offsets[1:]] - total[offsets[:-1]]


def codewords(n: int) -> np.ndarray:
    """n codewords of +-1 bits: all splits of up to five languages, a Hadamard-like seeded code beyond."""
    if n <= 5:
        splits = [[1 if i in s or i == 0 else -1 for i in range(n)] for k in range(n) for s in combinations(range(1, n), k) if k < n - 1]
        return np.array(splits, np.float64).T.reshape(n, -1)
    random, bits = np.random.default_rng(11), max(15, int(6 * np.log2(n)))
    tries = [np.where(random.random((n, bits)) < 0.5, 1.0, -1.0) for _ in range(50)]
    return max(tries, key=lambda m: -(m @ m.T - 2 * bits * np.eye(n)).max())


class Decoder:
    """Bit classifiers and codewords; small, and sent to every worker."""

    def __init__(self, languages: Sequence[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray | None = None):
        self.languages, self.code, self.weights, self.bias = list(languages), code, weights.astype(np.float32), bias
        self.trust = np.ones(len(bias)) if trust is None else trust
        self.scale, self.limit = np.ones(LENGTHS), np.zeros(LENGTHS)

    def margins(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        hashed, letters = grams(texts)
        some = np.flatnonzero(letters)
        starts = (np.cumsum(letters) - letters)[some]
        out = np.zeros((len(texts), len(self.bias)))
        for bit in range(len(self.bias)):
            own = self.weights[bit]
            if len(some):
                at = own[hashed[0]] + own[hashed[1]] + own[hashed[2]]
                out[some, bit] = np.add.reduceat(at, starts, dtype=np.float64) / letters[some] * _SCALE + self.bias[bit]
        return out, letters

    def losses(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Loss of every codeword, and each text's length class."""
        margin, letters = self.margins(texts)
        loss = np.stack([(np.logaddexp(0, -margin * word) * self.trust).sum(1) for word in self.code], axis=1)
        return loss, np.where(letters > 0, np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), LENGTHS - 1), -1)

    def __call__(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its share, and whether the text is ambiguous."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        loss, length = self.losses(texts)
        none = length < 0
        share = np.where(none, 0.0, shares(loss, self.scale[length]).max(1))
        best = [UNDETERMINED if n else self.languages[i] for n, i in zip(none, loss.argmin(1))]
        return best, share, ~none & (gaps(loss) < self.limit[length])


def shares(loss: np.ndarray, scale: np.ndarray) -> np.ndarray:
    out = np.exp(-(loss - loss.min(1, keepdims=True)) * scale[:, None])
    return out / out.sum(1, keepdims=True)


def gaps(loss: np.ndarray) -> np.ndarray:
    """How much worse the second best codeword is."""
    if loss.shape[1] < 2:
        return np.full(len(loss), np.inf)
    two = np.partition(loss, 1, axis=1)
    return two[:, 1] - two[:, 0]


def pieces(texts: Sequence[str], seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Runs of 1, 2, 4 ... words of each text, and the text itself; with the text's number."""
    random, out, of = np.random.default_rng(seed), [], []
    for i, text in enumerate(texts):
        words, n = text.split(), 1
        while n < len(words):
            start = int(random.integers(0, len(words) - n + 1))
            out.append(" ".join(words[start : start + n]))
            of.append(i)
            n *= 2
        out.append(text)
        of.append(i)
    return out, np.array(of, np.int64)


def calibrate(decoder: Decoder, texts: Sequence[str], labels: Sequence[str], flagged: float = FLAGGED) -> Decoder:
    """Sets the bits' weights, the scales and the limits from texts that the classifiers have not seen."""
    if len(decoder.languages) < 2 or not len(texts):
        return decoder
    place = {name: i for i, name in enumerate(decoder.languages)}
    parts, of = pieces(texts)
    truth = np.array([place[labels[i]] for i in of.tolist()])
    margin, letters = decoder.margins(parts)
    decoder.trust = np.clip(2 * ((margin * decoder.code[truth] > 0)[letters > 0]).mean(0) - 1, 0.05, 1)
    loss, length = decoder.losses(parts)
    right, gap, found = loss.argmin(1) == truth, gaps(loss), []
    for c in range(LENGTHS):
        own = length == c
        if (own & right).sum() < FEWEST_PIECES:
            continue
        told = (1 - DOUBT) * np.eye(loss.shape[1])[truth[own]] + DOUBT / loss.shape[1]
        cost = lambda scale: -(told * np.log(shares(loss[own], np.full(own.sum(), scale)) + 1e-300)).sum(1).mean()
        found.append((c, min(np.geomspace(1e-4, 10, 60), key=cost), np.quantile(gap[own & right], flagged, method="lower")))
    for c in range(LENGTHS if found else 0):
        _, decoder.scale[c], decoder.limit[c] = min(found, key=lambda x: (abs(x[0] - c), x[0]))
    return decoder


def fit(texts: Sequence[str], labels: Sequence[str]) -> Decoder:
    """Logistic classifiers of the codewords' bits, on the mean of each text's n-grams; every fourth text calibrates."""
    languages = sorted(set(labels))
    if len(languages) < 2:
        return Decoder(languages, np.ones((len(languages), 1)), np.zeros((1, BUCKETS)), np.zeros(1))
    apart, count = [], dict.fromkeys(languages, 0)
    for i, label in enumerate(labels):
        count[label] += 1
        if count[label] % 4 == 0:
            apart.append(i)
    own = [i for i in range(len(texts)) if i not in set(apart)] if len(apart) < 1000 else sorted(set(range(len(texts))) - set(apart))
    code, known = codewords(len(languages)), [texts[i] for i in own]
    x = np.zeros((len(own), BUCKETS), np.float32)
    for a in range(0, len(own), 256):
        hashed, letters = grams(known[a : a + 256])
        rows, counts = np.repeat(np.arange(len(letters)), letters), x[a : a + 256]
        for order in hashed:
            counts += np.bincount(rows * BUCKETS + order, minlength=counts.size).reshape(counts.shape)
        counts *= np.float32(_SCALE) / np.maximum(letters, 1)[:, None].astype(np.float32)
    truth = code[np.searchsorted(languages, [labels[i] for i in own])].astype(np.float32)
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        yes, no = (np.log(x[truth[:, bit] == s].sum(0) + 1e-2 * _SCALE) for s in (1, -1))
        weights[:, bit] = (yes - np.log(np.exp(yes).sum())) - (no - np.log(np.exp(no).sum()))
    bias = np.zeros(code.shape[1], np.float32)
    speed_w, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(_STEPS):
        slope = -truth / (1 + np.exp(np.clip(truth * (x @ weights + bias), -30, 30))) / len(own)
        speed_w = 0.9 * speed_w - 2.0 * (x.T @ slope + 1e-6 * weights)
        speed_b = 0.9 * speed_b - 0.2 * slope.sum(0)
        weights, bias = weights + speed_w, bias + speed_b
    return calibrate(Decoder(languages, code, weights.T.copy(), bias), [texts[i] for i in apart], [labels[i] for i in apart])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Decoder:
    """Fits on a bounded sample of the rows with a language and a text that are not held out."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out()).select("lang", "text", F.xxhash64("text").alias("__hash"))
    hashed = cut_lineage(known.select("lang", "__hash", F.length("text").alias("__size")))  # so that texts are read once for all counts
    n = len(hashed.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if n > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    most = max(1, min(per_language, SAMPLE_ROWS // max(n, 1)))
    least = smallest(hashed, "lang", most, SAMPLE_CHARS // max(n, 1))
    drawn = known.join(F.broadcast(least), ["lang", "__hash"]).groupBy("lang", "__hash").agg(F.min("text").alias("text"))
    rows = sorted(drawn.select("lang", "__hash", "text").collect())
    rows = [r for r in rows if any(c.isalpha() for c in r.text)]
    return fit([r.text for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, decoder: Decoder | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every document."""
    decoder = decoder or learn(docs)

    def make():
        def apply(texts):
            best, share, ambiguous = decoder(texts)
            return [pa.array(best, pa.string()), pa.array(share), pa.array(ambiguous)]

        return apply

    return annotate(docs, make, "lang_pred string, score double, ambiguous boolean", [held_out().alias("held_out")])


def keep_identified(docs: DataFrame, languages: Sequence[str] | None = None, least_share: float = 0.5, ambiguous: bool = False) -> DataFrame:
    """The documents, all columns kept, whose predicted language is wanted (None: any that was learned) and clear.

    Texts that are null or without letters go, and so do those with a share below ``least_share`` and, unless
    ``ambiguous``, those whose best two languages lie too close together: mixed texts, other languages, noise. Where no
    language could be learned, all texts with letters stay. Equal rows stay or go together; null ids stay.
    """
    named = by_place(docs, "doc_id", "text", "lang")
    decoder, wanted = learn(named), None if languages is None else set(languages)

    def make():
        def apply(texts):
            if not decoder.languages:
                return pa.array([any(c.isalpha() for c in t or "") for t in texts], pa.bool_())
            best, share, unclear = decoder(texts)
            known = np.array([b != UNDETERMINED and (wanted is None or b in wanted) for b in best], bool)
            return pa.array(known & (share >= least_share) & (ambiguous | ~unclear))

        return apply

    return keep_where(named, make).toDF(*docs.columns)
