"""One stream, three sinks: good rows, rejects, and a line in the error log (S11, T10).

The reference prints a bad message and goes on, so nothing of it is left.
Here ``two_sinks`` is a ``foreachBatch`` writer that keeps the trace: a batch
is parsed once and written once, split by whether its messages are good, so
rows and rejects of a batch appear together.  The counts come from the same
pass (``observe``), and a batch with rejects adds one row to ``audit_errors``.

Every batch writes to folders named by its id and replaces them when it is
replayed, so nothing is there twice:

    <out>/messages/batch=<id>/ok=true    the good rows
    <out>/messages/batch=<id>/ok=false   the rejects with their raw text
    <audit>/batch=<id>                   the error row
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..schemas import schema
from ..session import path_exists
from .sources import tagged_orders, tagged_ticks

_MESSAGES = "messages"


def two_sinks(tag: Callable[[DataFrame], DataFrame], out: str, audit: str, component: str,
              clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc), rows: bool = True):
    """foreachBatch writer of a stream of messages.

    Without ``rows`` only the rejects are written: for a companion of a stateful stream
    that takes the good messages of the same source itself (``parse_ticks``, ``parse_orders``).
    ``tag`` parses them into a DataFrame with a boolean ``ok`` and the message as ``raw``
    (``tagged_ticks``, ``tagged_orders``); ``clock`` gives the time of an error row."""
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counted = tag(batch).withColumn("raw", F.when(~F.col("ok"), F.col("raw"))).observe(
            seen, F.count(F.lit(1)).alias("all"), F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("bad"))
        (counted if rows else counted.where("NOT ok")).write.mode("overwrite").partitionBy("ok").parquet(os.path.join(out, _MESSAGES, f"batch={batch_id}"))
        bad = int(seen.get["bad"] or 0)
        if bad:
            now = clock()
            row = (batch_id, component, now, f"batch {batch_id}: {bad} of {seen.get['all']} messages rejected")
            (batch.sparkSession.createDataFrame([row], schema("audit_errors"))
                  .write.mode("overwrite").parquet(os.path.join(audit, f"batch={batch_id}")))
    return write


#: how each kind of message is parsed, and the columns of an untouched message
KINDS = {"ticks": (tagged_ticks, "seq bigint, value string"), "orders": (tagged_orders, "timestamp timestamp, value string")}


def _written(spark: SparkSession, out: str, kind: str, ok: bool) -> DataFrame:
    folder = os.path.join(out, _MESSAGES)
    tag, untouched = KINDS[kind]
    known = tag(spark.createDataFrame([], untouched)).schema.add("batch", LongType())
    if not path_exists(spark, folder):
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(folder).where(F.col("ok") == ok)


def good_ticks(spark: SparkSession, out: str) -> DataFrame:
    """The ticks a stream of tick messages has written so far."""
    return _written(spark, out, "ticks", True).select("seq", "tick.symbol", F.timestamp_seconds("tick.ts").alias("ts"),
                                                      "tick.price", "tick.size")


def rejected(spark: SparkSession, out: str, kind: str = "ticks") -> DataFrame:
    """The rejects so far, with their batch."""
    return _written(spark, out, kind, False).drop("ok", "tick", "o")


def audit_rows(spark: SparkSession, audit: str) -> DataFrame:
    """The error rows so far."""
    if not path_exists(spark, audit):
        return spark.createDataFrame([], schema("audit_errors"))
    return spark.read.schema(schema("audit_errors")).option("recursiveFileLookup", True).parquet(audit)


def keep_rejects(messages: DataFrame, out: str, audit: str, component: str, kind: str = "ticks", rows: bool = True):
    """Start a stream of messages of one kind into the sinks (``two_sinks``); its checkpoint is below ``out``."""
    return (messages.writeStream.foreachBatch(two_sinks(KINDS[kind][0], out, audit, component, rows=rows))
                    .option("checkpointLocation", os.path.join(out, "checkpoint")).trigger(availableNow=True).start())
