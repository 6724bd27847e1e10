"""Delivery dedup (T9): at-least-once delivery repeats events; consumers drop
repeats by event id within the watermark, so the state holds only ids of the
last ``delay`` of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedup_events(events: DataFrame, id_col: str = "event_id", ts_col: str = "ts",
                 delay: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])
