"""Last-wins rows of a stream with keyed state: what a late page brings is dropped by position, without a look at the sink.

The state of a key is a position (and a time), never a row. Without times, keys lie on shelves by their hash, and a shelf
is one entry of the state store: a batch asks for each shelf that it touches once, and not for each key. Each batch gives
the rows that take the lead of their keys;
``run`` puts them into a table in buckets, of which only touched ones are rewritten, so that neither state nor sink is read
as a whole. State lies in RocksDB: set ``spark.sql.streaming.stateStore.providerClass`` to ``PROVIDER``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from .incremental import guard_parameters, read_buckets, upsert_buckets

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Entries of the state store that the keys of a stream without times lie in, by their hash.
SHELVES = 4096


class Shelf(StatefulProcessor):
    """Per shelf: the greatest position so far of each of its keys. A batch gives the new leaders of the keys.

    A shelf's keys and positions are read and written as a whole, so that work grows with the rows and with the shelves
    that are touched; memory holds one shelf and a row for each of its keys that the batch brings.
    """

    def __init__(self, columns: list[str], key_type, pos: int, pos_type):
        self.columns, self.key_type, self.pos, self.pos_type = columns, key_type, pos, pos_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lead = handle.getValueState("lead", StructType([StructField("keys", ArrayType(self.key_type)), StructField("pos", ArrayType(self.pos_type))]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.lead.get()
        lead, best = dict(zip(*kept)) if kept else {}, {}
        for row in rows:
            own, at = row[len(self.columns)], row[self.pos]
            if own not in lead or at > lead[own]:
                lead[own], best[own] = at, row
        if best:
            self.lead.update((list(lead), list(lead.values())))
        for row in best.values():
            yield Row(**dict(zip(self.columns, row)))

    def close(self) -> None:
        pass


class Leader(StatefulProcessor):
    """Per key: the greatest (time, position) so far. A batch gives the key's new leader, or nothing where an older row leads.

    A timer at the leader's time drops the state once the watermark has passed it, since rows below the watermark are left
    out before they come here: all later ones win anyway.
    """

    def __init__(self, columns: list[str], pos: int, pos_type):
        self.columns, self.pos, self.pos_type = columns, pos, pos_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lead = handle.getValueState("lead", StructType([StructField("millis", LongType()), StructField("pos", self.pos_type)]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.lead.get()
        lead, best = tuple(kept) if kept else None, None
        for row in rows:
            at = (row[len(self.columns)], row[self.pos])
            if lead is None or at > lead:
                lead, best = at, row
        if best is None:
            return
        self.lead.update(lead)
        if kept:
            self.handle.deleteTimer(kept[0])
        self.handle.registerTimer(lead[0])
        yield Row(**dict(zip(self.columns, best)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.lead.clear()
        return iter([])

    def close(self) -> None:
        pass


def _identity(name: str, kind: DataType) -> Column:
    """A key as a value that is equal in Python just where it is in Spark; its JSON text where its type has none."""
    if isinstance(kind, (StringType, ByteType, ShortType, IntegerType, LongType, DecimalType, DateType, BooleanType)):
        return F.col(name)
    own = F.col(name) + F.lit(0.0) if isinstance(kind, (FloatType, DoubleType)) else F.col(name)  # one zero
    return F.to_json(F.struct(own.alias("key")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def leaders(stream: DataFrame, key: str, pos: str, time: str | None = None, late: str = "1 day", shelves: int = SHELVES) -> DataFrame:
    """The rows of a stream that take the lead of their keys: greatest ``pos``, or greatest (``time``, ``pos``).

    Of rows with equal positions the first to come stays. Rows with a null key, position or time are left out. Without a
    time the state holds a position for each key for ever, in ``shelves`` entries (as many in every run of a checkpoint);
    with one, rows that are ``late`` behind the newest are left out and keys older than that need no state.
    """
    if stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {PROVIDER}")
    # Workers change names that are no identifiers, so columns travel under names by place.
    names = {c: f"c{i}" for i, c in enumerate(stream.columns)}
    rows = stream.toDF(*names.values())
    rows = rows.filter(F.col(names[key]).isNotNull() & F.col(names[pos]).isNotNull())
    if time:
        at = names[time]
        rows = rows.filter(F.col(at).isNotNull()).withWatermark(at, late).withColumn("millis", F.unix_millis(at))
    position, kind = stream.columns.index(pos), stream.schema[pos].dataType
    if time:
        rows, own = rows.withColumn("grouped", F.col(names[key])), Leader(list(names.values()), position, kind)
    else:
        rows = rows.withColumn("own", _identity(names[key], stream.schema[key].dataType))
        rows = rows.withColumn("grouped", F.pmod(F.xxhash64("own"), F.lit(shelves)))
        own = Shelf(list(names.values()), rows.schema["own"].dataType, position, kind)
    schema = StructType([StructField(names[f.name], f.dataType) for f in stream.schema])
    return rows.groupBy("grouped").transformWithState(own, schema, "update", "EventTime" if time else "None").toDF(*names)


def run(stream: DataFrame, path: str, checkpoint: str, key: str, pos: str, time: str | None = None, late: str = "1 day", buckets: int = 64, shelves: int = SHELVES) -> DataFrame:
    """Brings the table in buckets at ``path`` up to what the stream holds by now; reads it back.

    A batch that is repeated after a crash starts from the state before it and so writes the same rows again.
    """
    spark = stream.sparkSession
    quoted = lambda name: name.replace("`", "``")
    schema = ", ".join(f"`{quoted(f.name)}` {f.dataType.simpleString()}" for f in stream.schema)

    def put(batch: DataFrame, number: int) -> None:
        upsert_buckets(batch.sparkSession, path, schema, batch.withColumn("__order", F.col(pos)), key, "__order", buckets)

    guard_parameters(spark, f"{path}/_shelves", {"key": key, "pos": pos, "time": time, "shelves": None if time else shelves})
    leaders(stream, key, pos, time, late, shelves).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_buckets(spark, path, schema)
