"""Packing documents into sequences of bounded length, online and in bounded space.

Each task keeps ``open_windows`` windows. A document's whole windows are emitted at once; its rest goes into the
open window where it fits best. If it fits nowhere and no further window may be opened, the fullest is topped up with
a cut of the rest and emitted. What a task has open at its end is merged into one window below full size; those of
``MERGED`` neighbouring tasks are then merged in the same way. So only the last window of every such group is padded.

Defined results: a null or empty text is the end id alone; a null id stays null; equal rows are packed once each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import pieces
from .bpe import Encoder

SIZE = 1024
OPEN_WINDOWS = 8
END_ID = 0
#: Tasks whose last windows are merged together.
MERGED = 32
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Windows:
    """The open windows of one task. A piece is (document id, start, ids, tokens of the document)."""

    def __init__(self, first_id: int, size: int = SIZE, most: int = OPEN_WINDOWS):
        self.size, self.most, self.next_id = size, most, first_id
        self.open: list[tuple[int, list]] = []
        self.rows: list[tuple] = []

    def emit(self, window: list, with_ids: bool = False) -> None:
        offset = 0
        for doc, start, ids, tokens in window:
            raw = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(raw), tokens, self.next_id, offset, raw if with_ids else None))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, ids: np.ndarray, tokens: int) -> None:
        while len(ids) >= self.size:
            self.emit([(doc, start, ids[: self.size], tokens)])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            fits = [(self.size - fill, i) for i, (fill, _) in enumerate(self.open) if self.size - fill >= len(ids)]
            if fits:
                room, i = min(fits)
                fill, window = self.open[i]
                window.append((doc, start, ids, tokens))
                if room == len(ids):
                    self.emit(window)
                    del self.open[i]
                else:
                    self.open[i] = (fill + len(ids), window)
                return
            if len(self.open) < self.most:
                self.open.append((len(ids), [(doc, start, ids, tokens)]))
                return
            fullest = max(range(len(self.open)), key=lambda i: self.open[i][0])
            fill, window = self.open.pop(fullest)
            room = self.size - fill
            self.emit([*window, (doc, start, ids[:room], tokens)])
            start, ids = start + room, ids[room:]

    def merge(self) -> list:
        """Pours all open windows into one another; full ones are emitted, the last one is returned."""
        last, fill = [], 0
        for _, window in sorted(self.open, key=lambda w: -w[0]):
            for doc, start, ids, tokens in window:
                while len(ids):
                    part = ids[: self.size - fill]
                    last.append((doc, start, part, tokens))
                    start, ids, fill = start + len(part), ids[len(part) :], fill + len(part)
                    if fill == self.size:
                        self.emit(last)
                        last, fill = [], 0
        self.open = []
        return last

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, json_path: str, ranks_path: str, size: int = SIZE, open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of a document in a sequence; see the module's text for columns and defined cases."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("rest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(json_path, ranks_path)  # one a task: an idle worker keeps no vocabulary
        windows = Windows((TaskContext.get().partitionId() + 1) << 32, size, open_windows)
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        for batch, texts in pieces(batches, "text"):
            ids, offsets = encode(texts)
            for doc, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                windows.add(doc, 0, np.append(ids[a:b], np.uint32(END_ID)), b - a + 1)
            if windows.rows:
                yield table(windows.taken())
        last = windows.merge()
        if last:
            windows.emit(last, with_ids=True)
        if windows.rows:
            yield table(windows.taken())

    def merge_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        windows = Windows((1 << 60) + (int(key[0]) << 32), size, 1)
        for _, own in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id", sort=True):
            window = [(None if pd.isna(r.doc_id) else int(r.doc_id), r.start, np.frombuffer(r.rest, "<u4"), r.doc_tokens) for r in own.itertuples()]
            windows.open.append((sum(len(p[2]) for p in window), window))
        if last := windows.merge():
            windows.emit(last)
        names = schema.names[:-1]
        return pd.DataFrame([r[:-1] for r in windows.taken()], columns=names).astype(dict.fromkeys(names, "Int64"))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = cut_lineage(source.mapInArrow(run, f"{COLUMNS}, rest binary"))
    whole = packed.filter("rest is null").drop("rest")
    rest = packed.filter("rest is not null").groupBy(F.expr(f"(sequence_id >> 32) div {MERGED}").alias("part"))
    return whole.unionByName(rest.applyInPandas(merge_group, COLUMNS))
