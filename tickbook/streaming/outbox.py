"""Streaming outbox publisher (T8): new outbox rows are routed and published
every trigger.

``foreachBatch`` writes the batch to the per-topic sink under a folder named
by the batch id, and then its ids to the ledger under the same name.  A batch
that is replayed after a failure (same batch id) skips a sink folder that is
committed already, but writes its part of the ledger again (overwrite), so a
crash between the two loses nothing.  Events that cannot be routed go to the
rejects of the batch and count as dispatched.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dispatch
from ..operators.outbox import pending, routable, route


def publish_batches(sink_dir: str, ledger_dir: str, rejects_dir: str | None = None, kafka_servers: str | None = None):
    """foreachBatch writer for a stream of outbox rows.

    With ``kafka_servers`` the sink is Kafka (needs the connector; a replay
    then sends the batch again, at least once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        from ..session import path_exists as _exists, scratch_path
        spark = batch.sparkSession
        path = scratch_path(spark, "publish-stream")
        pending(batch).withColumn("_ok", routable()).write.parquet(path)      # the batch is computed once
        events = spark.read.parquet(path)
        if events.isEmpty():
            return
        routed = route(events.where("_ok"))
        target = os.path.join(sink_dir, f"batch={batch_id}")
        if kafka_servers:
            (routed.select("topic", "key", "value").write.format("kafka")
                   .option("kafka.bootstrap.servers", kafka_servers).save())
        elif not _exists(spark, os.path.join(target, "_SUCCESS")):
            routed.write.mode("overwrite").partitionBy("topic").parquet(target)
        if rejects_dir:
            (events.where("NOT _ok").drop("_ok").withColumn("reason", F.lit("payload"))
                   .write.mode("overwrite").parquet(os.path.join(rejects_dir, f"batch={batch_id}")))
        dispatch.record(events, ledger_dir, batch_id)
    return write


def publish_stream(outbox_stream: DataFrame, sink_dir: str, ledger_dir: str, checkpoint: str,
                   available_now: bool = True, rejects_dir: str | None = None, kafka_servers: str | None = None):
    w = (outbox_stream.writeStream.foreachBatch(publish_batches(sink_dir, ledger_dir, rejects_dir, kafka_servers))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
