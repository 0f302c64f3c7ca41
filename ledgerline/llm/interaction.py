"""How document filters act on one another: what each removes in every order, and what only it would remove.

Each text is routed by its xxhash to one task, which keeps the chain of different texts of one hash with the full text
and the smallest id of each, so that all other ids of a text are known to repeat it. A document's failures are a bit
mask; counts of masks, a vector for each part, are merged by ``combineByKey``. All orders follow from the vectors.

Before the routing every task joins the equal texts of its own documents, in a table of bounded size: of a text with
very many copies one row a task is routed, and the ids known to be repeats go on without text.

Defined results: a null text is an empty one; a null part is the empty string; a null id repeats nothing, is repeated
by nothing and has no label; rows of equal id and text do not repeat one another; several labels of one id count as one
that has a quality (or toxicity) of 1 if any has; ids of labels without a document count nowhere; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The limits of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, CAPITALS, SYMBOLS = 200, 50, 2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: A failure condition of a text: its UTF-8 bytes, its words (split at ASCII white space) and its number of code points.
Rule = Callable[[bytes, list[bytes], int], bool]
RULES: dict[str, Rule] = {
    "A": lambda text, words, chars: len(words) < LEAST_WORDS,
    "B": lambda text, words, chars: 100 * len(set(words)) < LEAST_DISTINCT * len(words),
    "C": lambda text, words, chars: 100 * (len(text) - len(text.translate(None, CAPITALS))) > MOST_CAPITALS * chars,
    "D": lambda text, words, chars: len(text.translate(None, SYMBOLS)) < len(text),
}
REPEATED = "E"
#: Bytes of text that a task holds to find equal ones before the routing.
HELD = 8 << 20
#: Bytes of text that are routed to one task, if no text repeats.
ROUTED = 32 << 20
#: All orders of k filters are k! rows a part.
MOST_FILTERS = 7
MASKS = "doc_id long, part string, mask int, n long"
COLUMNS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


class Chain:
    """The different texts of one hash: of each the full text, the smallest id, its mask and the parts of its rows."""

    def __init__(self, repeated: int):
        self.repeated, self.entries = repeated, []

    def add(self, text: bytes, doc: int, mask: int, parts: dict[str, int]) -> Iterator[tuple[int, str, int, int]]:
        """Takes a row in; gives back the rows that are now known to repeat a smaller id's text."""
        for entry in self.entries:
            if entry[0] == text:
                break
        else:
            self.entries.append([text, doc, mask, dict(parts)])
            return
        if doc < entry[1]:
            late, entry[1], entry[3] = (entry[1], entry[3]), doc, dict(parts)
        elif doc > entry[1]:
            late = doc, parts
        else:
            for part, n in parts.items():
                entry[3][part] = entry[3].get(part, 0) + n
            return
        for part, n in late[1].items():
            yield late[0], part, mask | self.repeated, n


def masks(docs: DataFrame, rules: dict[str, Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", part_col: str | None = "source", held: int = HELD) -> DataFrame:
    """(doc_id, part, mask, n): the failures of each document, bit i for the i-th rule, the next bit for a repeated text.

    n is 1, but for rows of equal id, part and text and for null ids, which may be counted in one row.
    """
    tests, repeated = list(rules.values()), 1 << len(rules)
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")) if part_col else F.lit("")
    own = docs.select(F.col(id_col).cast("long").alias("id"), part.alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.select("id", "part", F.xxhash64("text"), F.char_length("text"), F.col("text").cast("binary"))

    def judge(index: int, rows: Iterator) -> Iterator[tuple[int, tuple]]:
        chains: dict[int, Chain] = {}
        known: Counter = Counter()
        size = 0

        def flush() -> Iterator[tuple[int, tuple]]:
            for key, chain in chains.items():
                for text, doc, mask, parts in chain.entries:
                    yield key, (text, doc, mask, parts)
            for (doc, part, mask), n in known.items():
                yield index if doc is None else hash(doc), (None, doc, mask, {part: n})
            chains.clear()
            known.clear()

        for doc, part, key, chars, text in rows:
            text = bytes(text)
            words = text.split()
            mask = sum(1 << i for i, test in enumerate(tests) if test(text, words, chars))
            if doc is None:
                known[None, part, mask] += 1
            else:
                chain = chains.get(key) or chains.setdefault(key, Chain(repeated))
                before = len(chain.entries)
                for *row, n in chain.add(text, doc, mask, {part: 1}):
                    known[tuple(row)] += n
                size += len(text) * (len(chain.entries) - before)
            size += 100
            if size >= held:
                yield from flush()
                size = 0
        yield from flush()

    def find(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int | None, str, int, int]]:
        """Rows come sorted by hash: one chain is held at a time."""
        chain, at = Chain(repeated), None

        def ended() -> Iterator[tuple[int, str, int, int]]:
            for _, doc, mask, parts in chain.entries:
                for part, n in parts.items():
                    yield doc, part, mask, n

        for key, (text, doc, mask, parts) in rows:
            if text is None:
                for part, n in parts.items():
                    yield doc, part, mask, n
                continue
            if key != at:
                yield from ended()
                chain, at = Chain(repeated), key
            yield from chain.add(text, doc, mask, parts)
        yield from ended()

    size = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    read: RDD = own.rdd.map(tuple)
    routed = read.mapPartitionsWithIndex(judge).repartitionAndSortWithinPartitions(1 + size // ROUTED, lambda key: key)
    return docs.sparkSession.createDataFrame(routed.mapPartitions(find), MASKS, verifySchema=False)


def repeated_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids whose text is also that of a smaller id, one row a document."""
    found = masks(docs, {}, id_col, text_col, None)
    return found.filter("mask = 1").select(F.explode(F.array_repeat("doc_id", F.col("n").cast("int"))).alias("doc_id"))


class Orders:
    """What every order of the filters removes, from the counts of masks."""

    def __init__(self, names: str):
        self.names = names
        self.orders = ["".join(o) for o in permutations(names)]
        bits = np.arange(1 << len(names))
        of = {n: 1 << i for i, n in enumerate(names)}
        steps = [(o, k, of[n], sum(of[x] for x in o[:k])) for o in self.orders for k, n in enumerate(o)]
        fails, before = np.array([[f] for *_, f, _ in steps]), np.array([[b] for *_, b in steps])
        self.steps = [(o, k + 1) for o, k, *_ in steps]
        self.filter = np.array([int(f).bit_length() - 1 for *_, f, _ in steps])
        hit = (bits & fails) > 0
        self.removed, self.redundant = hit & ((bits & before) == 0), hit & ((bits & before) > 0)
        self.kept, self.alone = (bits & (fails | before)) == 0, bits == fails

    def rows(self, part: str, counts: np.ndarray) -> Iterator[tuple]:
        """``counts``: of each mask all documents, those labelled good, those labelled toxic."""
        n, good, toxic = counts
        removed = self.removed @ n
        shapley = np.bincount(self.filter, removed, len(self.names)).astype(np.int64) if removed.max() < 1 << 40 else np.array([sum(removed[self.filter == i].tolist()) for i in range(len(self.names))])
        table = np.stack([self.kept @ n, removed, self.redundant @ n, self.alone @ n, self.removed @ good, self.removed @ toxic, shapley[self.filter]], 1)
        for (order, step), values in zip(self.steps, table.tolist()):
            yield (part, order, step, *values)


def audit(docs: DataFrame, labels: DataFrame, rules: dict[str, Rule] = RULES, repeated: str = REPEATED, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows for each part, order of the filters and step; see the module's text for the defined cases.

    kept and removed are counts after and at the step; redundant failed the filter but had gone before; unique_fails
    fail no other filter; good_lost and toxic_lost are those removed with such a label; shapley is what the step's
    filter removes, summed over all orders.
    """
    names = "".join(rules) + repeated
    if len(names) > MOST_FILTERS or len(set(names)) < len(rules) + 1:
        raise ValueError(f"at most {MOST_FILTERS} filters, each named by a letter of its own")
    spark, size = docs.sparkSession, 1 << len(names)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).filter("good or toxic")
    known = known.groupBy("doc_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    found = masks(docs, rules, id_col, text_col, part_col).join(known, "doc_id", "left")
    counted = found.groupBy("part", "mask").agg(F.sum("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)))

    def add(counts: np.ndarray, value: tuple) -> np.ndarray:
        counts[:, value[0]] += value[1:]
        return counts

    parts = counted.rdd.map(lambda r: (r[0], tuple(r[1:])))
    vectors = parts.combineByKey(lambda value: add(np.zeros((3, size), np.int64), value), add, lambda a, b: a + b, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def spell(rows: Iterator[tuple[str, np.ndarray]]) -> Iterator[tuple]:
        orders = Orders(names)
        for part, counts in rows:
            yield from orders.rows(part, counts)

    return spark.createDataFrame(vectors.mapPartitions(spell), COLUMNS, verifySchema=False)
