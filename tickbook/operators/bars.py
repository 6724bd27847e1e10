"""OHLC bars from ticks (batch; the streaming job reuses ``bar_aggs``).

Open and close are the prices of the first and last tick in event-time
order, with the tick sequence number breaking ties, not in arrival order
(the reference's quirk).  ``volume`` counts ticks as the reference does;
``traded_size`` adds the summed tick size.  Two-phase aggregation: partial
min_by/max_by/min/max/count per map task, so a hot symbol costs one partial
row per task and minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import floor_to

BAR_COLS = ["symbol", "minute_ts", "open_price", "high_price", "low_price", "close_price", "volume", "tick_count"]


def bar_aggs(with_size: bool = False) -> list[Column]:
    order = F.struct("ts", "seq")
    aggs = [F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.count(F.lit(1)).alias("volume"),
            F.count(F.lit(1)).alias("tick_count")]
    if with_size:
        aggs.append(F.sum("size").cast("bigint").alias("traded_size"))
    return aggs


def bars(ticks: DataFrame, unit: str = "minute", with_size: bool = False) -> DataFrame:
    """One bar per (symbol, ``unit``): minute_ts is the bar start."""
    return clean_ticks(ticks).groupBy("symbol", floor_to("ts", unit).alias("minute_ts")).agg(*bar_aggs(with_size))


def clean_ticks(ticks: DataFrame) -> DataFrame:
    """Drop ticks with an empty symbol or no price (the consumers' guard)."""
    return ticks.filter((F.length("symbol") > 0) & F.col("price").isNotNull())
