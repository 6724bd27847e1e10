"""Streaming one-minute bars (T1-T4).

The reference flushes a minute when a tick of a later minute arrives and
never flushes the last one; that is an event-time watermark with zero delay
and append output: a bar is emitted once the watermark passes its end, the
last open bar stays in state.  Late ticks (behind the watermark) are dropped
instead of re-opening and overwriting a flushed bar (quirk Q7).  The delay is
a parameter.  Bars aggregate with the batch operator's expressions.

``late_bars`` is the update mode: every trigger's ticks become partial bars
that are merged into a ``bar_table``, so a tick corrects its bar however late
it comes.  It needs no watermark and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bars import bar_aggs, clean_ticks


def stream_bars(ticks: DataFrame, width: str = "1 minute", delay: str = "0 seconds",
                with_size: bool = False) -> DataFrame:
    """ticks(symbol, ts timestamp, price, seq[, size]) -> closed bars (append mode)."""
    bars = (clean_ticks(ticks).withWatermark("ts", delay)
                 .groupBy(F.window("ts", width).alias("w"), "symbol")
                 .agg(*bar_aggs(with_size)))
    cols = ["symbol", F.col("w.start").cast("timestamp_ntz").alias("minute_ts"), "open_price", "high_price",
            "low_price", "close_price", "volume", "tick_count"]
    return bars.select(*cols, *(["traded_size"] if with_size else []))


def late_bars(table: str, compact_every: int = 50):
    """foreachBatch writer of ticks into the bar table ``table``.

    Every ``compact_every`` batches the parts are merged.  A replayed batch counts once;
    a tick that is delivered in two batches counts twice (remove it before, see
    ``dedup_events``)."""
    from ..operators import bar_table

    def write(ticks: DataFrame, batch: int) -> None:
        bar_table.add(bar_table.bar_parts(ticks), table, batch)
        if (batch + 1) % compact_every == 0:
            bar_table.compact(ticks.sparkSession, table)
    return write


def upsert_bars_batch(table_path: str):
    """foreachBatch writer: MERGE each micro-batch's bars into fact_tick_agg
    (partitioned by day), the reference's per-minute MERGE as a set."""
    from ..operators.upsert import write_upsert

    def write(batch: DataFrame, _epoch: int) -> None:
        if batch.isEmpty():  # e.g. the first trigger, before the watermark closes a window
            return
        b = batch.withColumn("bar_day", F.to_date("minute_ts"))
        write_upsert(batch.sparkSession, table_path, b, ["symbol", "minute_ts"], "bar_day")
    return write
