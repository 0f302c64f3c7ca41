"""Quality rules: statistics of whole texts, and isolation forests on them.

A forest is grown for every group of statistics in ``GROUPS``; a document's score in a group comes from its mean path
length over the random splits. As in every isolation forest a tree is grown on few rows (``SUBSAMPLE``), which each tree
draws anew from all distinct texts of the table that pass the base rule (half of them in a small table). Each group's
threshold is calibrated on all labelled texts, each scored by the trees that have not drawn it: it is the lowest at which
the group rejects at most its share of ``FALSE_REJECTS`` of the good ones, an exact order statistic; a group that does not
single out bad ones at its threshold has no say (with fewer than ``FEWEST_BAD`` bad ones, all statistics together decide).
``score`` is the highest ratio of a group's score to its threshold: documents above 1 are rejected.

Texts are read once for the statistics, which are kept in the checkpoint folder; scores are counted by ranges of their
bits, so that neither the driver nor a task holds more than these counts.

Defined results: a null or empty text has no words and fails the base rule; a null id stays null; equal rows are judged
alike, each for itself; of several labels of one id the lowest counts; no good labels: ``DEFAULT_THRESHOLD`` holds for
all statistics together; an empty table gives no rows; other columns are not read by ``judge_quality`` and are kept by
``keep_quality``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import CHARS_AT_ONCE, annotate, bounded_batches, keep_where
from .columns import by_place
from .segments import code_points, hashes, is_space, mix, slices, words

#: Trees of a forest, and the texts that each one draws from all.
TREES, SUBSAMPLE = 48, 256
#: Characters of the texts that are judged at once (statistics are taken in smaller parts).
SCORED_AT_ONCE = 2_000_000
#: Good rows that all groups together may reject; a group must catch bad rows so many times as often as good ones, and
#: so many of them.
FALSE_REJECTS, WORTH, FEWEST_BAD = 0.01, 5, 3
DEFAULT_THRESHOLD = 0.65
#: The statistics of each forest, by their places in ``features``: all together, and each alone, so that what is odd in
#: one of them is not lost among the others.
GROUPS = [tuple(range(9)), *((i,) for i in range(9))]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.zeros(129, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_PUNCTUATION = np.zeros(129, bool)
_PUNCTUATION[[ord(c) for c in "!?.,;:\"'()[]{}-_=+/\\@^~`"]] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a key equals another one, and where it equals an earlier one (keys in their order)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    any_, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    any_[order[1:]] = same
    later[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def statistics(texts: Sequence[str | None]) -> dict[str, np.ndarray]:
    """The base statistics of each text and further counts for the forest."""
    points, offsets = code_points(texts)
    docs = len(texts)
    starts, ends, n_words = words(points, offsets)
    of_word = np.repeat(np.arange(docs), n_words)
    key = hashes(points, starts, ends)
    salt = mix(np.arange(docs, dtype=np.uint64) + np.uint64(1))
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (of_word[1:] == of_word[:-1])
    n = max(len(key) - 2, 0)
    window = mix(key[:n] * np.uint64(3) + mix(key[1 : n + 1] * np.uint64(5) + mix(key[2 : n + 2])))
    inside = of_word[:n] == of_word[2 : n + 2]
    repeated = np.zeros(len(key), bool)
    at = np.flatnonzero(inside)
    twice = at[_repeats(window[at] ^ salt[of_word[at]])[0]]
    for k in range(3):
        repeated[twice + k] = True
    by_word = np.concatenate([[0], np.cumsum(n_words)])
    breaks = np.flatnonzero(points == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(points)]
    line_ends = np.append(line_starts[1:], len(points))
    line_ends = np.where((line_ends > line_starts) & (np.append(points, 0)[np.maximum(line_ends - 1, 0)] == 10), line_ends - 1, line_ends)
    solid = np.concatenate([[0], np.cumsum(~is_space(points))])
    with_word = solid[line_ends] > solid[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    of_line = np.searchsorted(offsets, line_starts, side="right") - 1
    again = _repeats(hashes(points, line_starts, line_ends) ^ salt[of_line])[1]
    ascii_ = np.minimum(points, 128)
    return {
        "n_words": n_words,
        "word_chars": _per_text(~is_space(points), offsets),
        "n_symbols": _per_text(_SYMBOLS[ascii_], offsets),
        "n_dup_lines": np.bincount(of_line[again], minlength=docs),
        "n_repeat_words": _per_text(repeated, by_word),
        "n_lines": np.bincount(of_line, minlength=docs),
        "n_upper": _per_text((points >= 65) & (points <= 90), offsets),
        "n_digits": _per_text((points >= 48) & (points <= 57), offsets),
        "n_punctuation": _per_text(_PUNCTUATION[ascii_], offsets),
        "n_same_words": _per_text(same, by_word),
    }


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees: rates of the statistics, so that a text's length alone says little."""
    s = {k: v.astype(np.float64) for k, v in stats.items()}
    of_words, of_chars, of_lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    columns = [np.minimum(np.log1p(s["n_words"]), 6), s["word_chars"] / of_words, s["n_symbols"] / of_words, s["n_dup_lines"] / of_lines, s["n_repeat_words"] / of_words, s["n_upper"] / of_chars, s["n_digits"] / of_chars, s["n_punctuation"] / of_chars, s["n_same_words"] / of_words]
    return np.column_stack(columns)


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


class IsolationForest:
    """Trees as arrays: of each node the feature, cut and left child (right is next to it), or a leaf's path length."""

    def __init__(self, rows: np.ndarray | list[np.ndarray], trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7):
        """``rows`` to draw from, or a list of what each tree has drawn."""
        random = np.random.default_rng(seed)
        drawn = isinstance(rows, list)
        self.size = len(rows[0]) if drawn else min(subsample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        self.trees = [self._grow(rows[i] if drawn else rows[random.choice(len(rows), self.size, replace=False)], random) for i in range(len(rows) if drawn else trees)]

    @staticmethod
    def _expected(n: float) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, length = [0], [0.0], [-1], [0.0]
        todo = [(0, rows, 0)]
        while todo:
            node, own, depth = todo.pop()
            spread = np.flatnonzero(own.max(0) > own.min(0)) if len(own) > 1 and depth < self.depth else []
            if not len(spread):
                length[node] = depth + self._expected(len(own))
                continue
            f = int(random.choice(spread))
            c = random.uniform(own[:, f].min(), own[:, f].max())
            low = own[:, f] <= c
            feature[node], cut[node], left[node] = f, c, len(left)
            for part in (own[low], own[~low]):
                todo.append((len(left), part, depth + 1))
                feature.append(0), cut.append(0.0), left.append(-1), length.append(0.0)
        return np.array(feature), np.array(cut), np.array(left), np.array(length)

    def score(self, rows: np.ndarray, drew: np.ndarray | None = None) -> np.ndarray:
        """0 to 1; near 1 for rows that few splits set apart. Trees have no say on rows that they ``drew`` (tree by row),
        unless all did."""
        total, trees = np.zeros(len(rows)), np.full(len(rows), len(self.trees))
        if drew is not None:
            drew = drew & ~drew.all(0)
            trees -= drew.sum(0)
        for i, (feature, cut, left, length) in enumerate(self.trees):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                inner = left[node] >= 0
                node = np.where(inner, left[node] + (rows[np.arange(len(rows)), feature[node]] > cut[node]), node)
            total += length[node] if drew is None else np.where(drew[i], 0.0, length[node])
        return 2.0 ** (-total / trees / max(self._expected(self.size), 1e-9))


class Judge:
    """Grown forests with their columns and thresholds: small, and sent to every worker."""

    def __init__(self, forests: Sequence[tuple[tuple[int, ...], IsolationForest, float]]):
        self.forests = list(forests)

    def ratio(self, seen: np.ndarray) -> np.ndarray:
        """The highest ratio of a score to its threshold."""
        out = np.zeros(len(seen))
        for columns, forest, threshold in self.forests:
            out = np.maximum(out, forest.score(seen[:, columns]) / threshold)
        return out

    def __call__(self, texts: Sequence[str | None]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        parts = [statistics(texts[a:b]) for a, b in slices([len(t or "") for t in texts], CHARS_AT_ONCE)]
        stats = {n: np.concatenate([part[n] for part in parts]) for n in _STATS} if parts else statistics([])
        failed = base_failed(stats)
        score = self.ratio(features(stats))
        return stats, failed, score, ~failed & (score <= 1)


_STATS = [*_BASE, "n_lines", "n_upper", "n_digits", "n_punctuation", "n_same_words"]


def measured(docs: DataFrame) -> DataFrame:
    """All statistics of every document with its text's hash (null for a null text), written once."""
    make = lambda: lambda texts: [pa.array(v, pa.int64()) for v in statistics(texts).values()]
    return cut_lineage(annotate(docs, make, ", ".join(f"{n} long" for n in _STATS), [F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("__hash")]))


def _table(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    return {n: batch.column(batch.schema.get_field_index(n)).to_numpy(**({"zero_copy_only": False} if isinstance(batch, pa.RecordBatch) else {})) for n in _STATS}


def labelled_texts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The distinct texts that pass the base rule, with their statistics and their lowest label, if any."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    fine = rows.filter(F.col("__hash").isNotNull() & (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words")))
    return cut_lineage(fine.join(known, "doc_id", "left").groupBy("__hash", *_STATS).agg(F.min("__quality").cast("int").alias("__quality")))


def draws(texts: DataFrame, size: int, trees: int = TREES) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(hashes, features) of the texts that each tree draws: those with the smallest hashes under the tree's own salt.

    Each task gives no more than these of its own; what all trees have drawn is ``trees`` times ``size`` rows.
    """
    salts = mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    names = ["__hash", *_STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # for each tree the places of its texts in their order, and the rows that any tree has drawn
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(names))])
            rows = rows if kept is None else np.concatenate([kept, rows])
            at = mix(rows[:, 0].astype(np.uint64)[None, :] ^ salts[:, None])
            best = np.argpartition(at, size - 1, axis=1)[:, :size] if len(rows) > size else np.broadcast_to(np.arange(len(rows)), (trees, len(rows)))
            kept = rows[np.unique(best)]
        if kept is None or not len(kept):
            return
        at = mix(kept[:, 0].astype(np.uint64)[None, :] ^ salts[:, None])
        for tree in range(trees):
            order = np.argsort(at[tree], kind="stable")[:size]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(order), tree, np.int32)), pa.array((at[tree][order] >> np.uint64(1)).astype(np.int64)), *(pa.array(kept[order, i]) for i in range(len(names)))], ["tree", "__at", *names])

    bounded_batches(texts.sparkSession)
    offered = texts.select(*names).mapInArrow(run, "tree int, __at long, " + ", ".join(f"{n} long" for n in names))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("__at", "__hash"))
    drawn = offered.withColumn("__rank", rank).filter(F.col("__rank") <= size).toPandas().sort_values(["tree", "__rank"])
    parts = [part for _, part in drawn.groupby("tree")]
    return [np.sort(part["__hash"].to_numpy(np.int64)) for part in parts], [features({n: part[n].to_numpy(np.int64) for n in _STATS}) for part in parts]


def told_scores(texts: DataFrame, hashes: Sequence[np.ndarray], forests: Sequence[tuple[tuple[int, ...], IsolationForest]]) -> DataFrame:
    """(quality, bits) of each labelled text: its scores by the trees that have not drawn it, as the bits of doubles,
    which have the order of the scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, own = features(_table(batch)), batch.column(0).to_numpy()
            drew = np.stack([np.isin(own, h) for h in hashes])
            bits = np.column_stack([forest.score(seen[:, columns], drew).view(np.int64) for columns, forest in forests])
            made = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * len(forests), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(batch.num_columns - 1), made], ["quality", "bits"])

    bounded_batches(texts.sparkSession)
    return cut_lineage(texts.filter("__quality is not null").select("__hash", *_STATS, "__quality").mapInArrow(run, "quality int, bits array<long>"))


def order_statistics(bits: DataFrame, groups: int, rank: int) -> list[int]:
    """For each place in the lists ``bits`` (longs, none negative) the value with so many before it, in order; exact.

    Values are counted by 16 bits at a time: the counts are all that leaves the workers.
    """
    long = bits.select(F.posexplode("bits").alias("group", "value"))
    found, left = [0] * groups, [rank] * groups
    for shift in (48, 32, 16, 0):
        begun = F.element_at(F.array(*(F.lit(x).cast("long") for x in found)), F.col("group") + 1)
        own = long if shift == 48 else long.filter(F.shiftright("value", shift + 16) == begun)
        counts = own.groupBy("group", F.shiftright("value", shift).bitwiseAND(F.lit(0xFFFF)).alias("part")).agg(F.count("*").alias("n")).toPandas().sort_values(["group", "part"])
        for g, part in counts.groupby("group"):
            so_far = part["n"].cumsum().to_numpy()
            i = int(np.searchsorted(so_far, left[g], "right"))
            left[g] -= int(so_far[i - 1]) if i else 0
            found[g] = (found[g] << 16) | int(part["part"].iloc[i])
    return found


def calibrate(docs: DataFrame, labels: DataFrame, sample_rows: int = SUBSAMPLE, false_rejects: float = FALSE_REJECTS) -> Judge:
    """Grows the forests on the trees' draws from all texts, of ``sample_rows`` each, and sets the thresholds by all labelled ones."""
    return _calibrated(measured(docs), labels, sample_rows, false_rejects)


def _calibrated(rows: DataFrame, labels: DataFrame, sample_rows: int = SUBSAMPLE, false_rejects: float = FALSE_REJECTS) -> Judge:
    texts = labelled_texts(rows, labels)
    n = texts.count()
    if not n:
        return Judge([])
    hashes, drawn = draws(texts, min(sample_rows, max(1, n // 2)))
    grown = [(columns, IsolationForest([own[:, columns] for own in drawn])) for columns in GROUPS]
    told = told_scores(texts, hashes, grown)
    number = {r.quality: r.n for r in told.filter("quality in (0, 1)").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n_good, n_bad = number.get(1, 0), number.get(0, 0)
    if not n_good:
        return Judge([(*grown[0], DEFAULT_THRESHOLD)])
    share = false_rejects / len(grown)
    lowest = order_statistics(told.filter("quality = 1"), len(grown), int(np.ceil((n_good - 1) * (1 - share))))
    above = [F.count_if(F.get("bits", F.lit(g)) > F.lit(x).cast("long")).alias(f"g{g}") for g, x in enumerate(lowest)]
    caught = told.filter("quality = 0").agg(*above).first() if n_bad >= FEWEST_BAD else None
    out = []
    for g, (columns, forest) in enumerate(grown):
        if (caught is None and columns == GROUPS[0]) or (caught is not None and caught[g] >= max(FEWEST_BAD, WORTH * n_bad * share)):
            out.append((columns, forest, float(np.int64(lowest[g]).view(np.float64))))
    return Judge(out)


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the base statistics, ``base_failed``, the forests' ``score`` and ``kept``."""
    rows = measured(docs)
    judge = _calibrated(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = _table(batch)
            failed, score = base_failed(stats), judge.ratio(features(stats))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(stats[n]) for n in _BASE), pa.array(failed), pa.array(score), pa.array(~failed & (score <= 1))], ["doc_id", *_BASE, "base_failed", "score", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in _BASE) + ", base_failed boolean, score double, kept boolean")


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules and the forests keep, with all their columns; texts that are null or empty go."""
    named = by_place(docs, "doc_id", "text")
    judge = calibrate(named, labels)
    return keep_where(named, lambda: lambda texts: pa.array(judge(texts)[3]), most=SCORED_AT_ONCE).toDF(*docs.columns)
