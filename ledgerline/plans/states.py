"""Queries of states that streams keep."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir, remove, table
from ..streaming import keyed
from .registry import query

_STORE = "spark.sql.streaming.stateStore.providerClass"


@query("SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def keyed_last_rows(spark, sf_dir):
    """Each customer's last order, from a stream that brings the orders in two deliveries, the second with many late ones.

    The second run goes on from the first one's state. Its result is a table of its own, so the stream's folders go.
    """
    folder, before = f"{checkpoint_dir(spark)}/deliveries-{uuid.uuid4().hex}", spark.conf.get(_STORE, None)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    spark.conf.set(_STORE, keyed.PROVIDER)
    try:
        for half in (1, 0):
            orders.filter(F.pmod("o_orderkey", F.lit(2)) == half).write.mode("append").parquet(f"{folder}/landed")
            stream = spark.readStream.schema(orders.schema).parquet(f"{folder}/landed")
            found = keyed.run(stream, f"{folder}/last", f"{folder}/checkpoint", "o_custkey", "o_orderkey", buckets=16)
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)
    for name in ("landed", "checkpoint"):
        remove(spark, f"{folder}/{name}")
    return found
