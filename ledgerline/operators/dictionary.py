"""A table of texts against a table of terms: one pass over each text finds all terms.

A small dictionary is searched for with an automaton (``functions.automaton``), a large one with a table of windows
(``functions.wordtable``): texts are read once in either case, and the work on a text grows with the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.automaton import Automaton
from ..functions.wordtable import WordTable
from ..session import cut_lineage

#: UTF-8 bytes of terms in an automaton: a byte is a state of 1 KiB at most.
AUTOMATON_BYTES = 64 << 10
#: UTF-8 bytes of the terms that are sent to all workers at once (a worker holds some ten times as much for terms of ten
#: bytes). A larger dictionary is split by hash, one pass over the texts for each part.
MOST_BYTES = 16 << 20
#: Bytes of text that a worker searches at once, with an automaton and with a table of windows.
AT_ONCE, TABLE_AT_ONCE = 4 << 20, 1 << 20
FOUND = "array<struct<pos: bigint, name: string, n: int, first: int>>"


def extensions(dictionary: DataFrame) -> DataFrame:
    """(term, longer): each term with the dictionary's terms that start with it, by an equality join on prefixes."""
    terms = dictionary.select("term").filter("term <> ''").distinct()
    starts = terms.select(F.col("term").alias("longer"), F.explode(F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.substring(F.col("term"), F.lit(1), i))).alias("term"), F.length("term").alias("n"))
    return starts.filter("n > 1").join(terms, "term").select("term", "longer")


def terms_in(docs: DataFrame, dictionary: DataFrame, key: str, text: str = "text", longer: DataFrame | None = None, most: int = MOST_BYTES) -> DataFrame:
    """(key, terms): the dictionary's terms that occur in each text, in dictionary order, with their number and first place.

    ``dictionary`` has pos, name, term; null and empty terms are none, a term with several names counts for each. With
    ``longer`` (term, longer), such as ``extensions`` gives, a term does not count where a longer one starts. A null text
    holds no term. Keys are unique; they are used to put the passes of a large dictionary together.
    """
    # Written once: a dictionary that comes from the texts themselves is a pass over them.
    terms = cut_lineage(dictionary.filter("term <> ''").select("pos", "name", "term"))
    ruled = longer.filter("longer <> ''").select("term", "longer").distinct() if longer is not None else None
    size = terms.select(F.octet_length("term").alias("n"))
    if ruled is not None:
        size = size.unionAll(ruled.join(terms.select("term").distinct(), "term").select(F.octet_length("longer").alias("n")))
    passes = -(-(size.agg(F.sum("n")).first()[0] or 0) // most) or 1
    part = F.pmod(F.xxhash64("term"), F.lit(passes))
    found = None
    for i in range(passes):
        own = terms.filter(part == i)
        rows = own.orderBy("pos", "term").toArrow().combine_chunks()  # bounded by ``most``
        pairs = ruled.filter(part == i).join(own.select("term").distinct(), "term").collect() if ruled is not None else []
        one = _one_pass(docs, rows, [tuple(r) for r in pairs], key, text)
        found = one if found is None else found.unionAll(one)
    if passes == 1:
        return found
    return found.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("terms"))).alias("terms"))


def _one_pass(docs: DataFrame, rows: pa.Table, pairs: Sequence[tuple], key: str, text: str) -> DataFrame:
    column = lambda c, kind: pa.concat_arrays([pa.array([], kind), *(x.cast(kind) for x in rows[c].chunks)])
    own = column("term", pa.large_string())
    terms = pc.unique(pa.concat_arrays([own, pa.array([longer for _, longer in pairs], pa.large_string())]))
    term_of = pc.index_in(own, terms).to_numpy(zero_copy_only=False).astype(np.int64)
    entry_of = np.argsort(term_of, kind="stable")
    counts = np.bincount(term_of, minlength=len(terms)).astype(np.int64)
    ruled: dict[int, list[int]] = {}
    if pairs:
        at = {t: i for i, t in enumerate(terms.to_pylist())}
        for term, longer in pairs:
            if longer.startswith(term) and longer != term:
                ruled.setdefault(at[term], []).append(at[longer])
    small = pc.sum(pc.binary_length(terms)).as_py() or 0
    finder, at_once = (Automaton(terms.to_pylist()), AT_ONCE) if small <= AUTOMATON_BYTES else (WordTable(terms), TABLE_AT_ONCE)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((finder, column("pos", pa.int64()), column("name", pa.string()), counts, entry_of, ruled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, places, names, counts, entry_of, ruled = shared.value
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            a = 0
            while a < len(texts):
                b, size = a + 1, len(texts[a])
                while b < len(texts) and size + len(texts[b]) <= at_once:
                    size += len(texts[b])
                    b += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _found(finder, texts[a:b], places, names, counts, entry_of, ruled)], [key, "terms"])
                a = b

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, terms {FOUND}")


def _found(finder: Automaton | WordTable, texts: list[bytes], places: pa.Array, names: pa.Array, counts: np.ndarray, entry_of: np.ndarray, ruled: dict[int, list[int]]) -> pa.Array:
    doc, start, term = finder.starts(texts)
    n = len(counts)
    if ruled and len(doc):
        lengths = np.array([len(t) for t in texts], np.int64)
        place = np.concatenate([[0], np.cumsum(lengths + 1)])[doc] + start
        void = np.zeros(len(doc), bool)
        order = np.argsort(term, kind="stable")
        bounds = np.searchsorted(term[order], np.arange(n + 1))
        of = lambda t: order[bounds[t] : bounds[t + 1]]
        for short, longer in ruled.items():
            own = of(short)
            if len(own):
                taken = [place[of(x)] for x in longer if bounds[x] < bounds[x + 1]]
                if taken:
                    void[own] = np.isin(place[own], np.concatenate(taken))
        doc, start, term = doc[~void], start[~void], term[~void]
    by = np.lexsort((start, term, doc))
    doc, start, term = doc[by], start[by], term[by]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])])) if len(doc) else np.zeros(0, np.int64)
    often = np.diff(np.append(new, len(doc)))
    doc, start, term = doc[new], start[new], term[new]
    chars = start + 1
    if not all(t.isascii() for t in texts):
        # Bytes that begin a character, before each place.
        begun = np.concatenate([[0], np.cumsum((np.frombuffer(b"".join(texts), np.uint8) & 0xC0) != 0x80)])
        begin = np.cumsum([0, *(len(t) for t in texts)])[doc]
        chars = begun[begin + start] - begun[begin] + 1
    many = counts[term]
    rows = np.repeat(np.arange(len(doc)), many)
    begin = np.concatenate([[0], np.cumsum(counts)])[term]
    entry = entry_of[np.repeat(begin, many) + np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)]
    by = np.lexsort((entry, doc[rows]))
    rows, entry = rows[by], entry[by]
    offsets = np.searchsorted(doc[rows], np.arange(len(texts) + 1))
    made = pa.StructArray.from_arrays([places.take(pa.array(entry)), names.take(pa.array(entry)), pa.array(often[rows], pa.int32()), pa.array(chars[rows].astype(np.int32))], ["pos", "name", "n", "first"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), made)
