"""A bar table that late ticks can correct.

A bar with only its four prices cannot take a late tick: whether the tick is
an earlier first or a later last one is not known any more.  Here a partial
bar also keeps when its first and last tick were, (ts, seq), so partial bars
of any two sets of ticks merge into the bar of both, in any order:

    open  = price of the smaller first,  close = price of the greater last,
    high, low = extremes,                counts and sizes add up.

The table is a folder.  ``add`` writes the partial bars of one batch of ticks
to ``part=<id>``, by day; a batch that is replayed replaces its own part, so
it counts once.  ``read_bars`` merges what is there, and only the days that
have parts: all others are read as they are.  ``compact`` merges the parts
into ``base=<id>``, which holds the touched days only; of a day the newest
base counts, and parts up to it are left out.  A part or base counts once it
is complete, so a crash at any place leaves a table that reads right.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import floor_to
from ..session import folders, path_exists
from .bars import BAR_COLS, clean_ticks

PART_SCHEMA = ("symbol string, minute_ts timestamp_ntz, open_price double, high_price double, low_price double, "
               "close_price double, volume bigint, tick_count bigint, traded_size bigint, first_ts timestamp_ntz, "
               "first_seq bigint, last_ts timestamp_ntz, last_seq bigint")
_KEYS = ["symbol", "minute_ts"]


def bar_parts(ticks: DataFrame, unit: str = "minute") -> DataFrame:
    """Partial bars of a batch of ticks (symbol, ts, seq, price[, size])."""
    size = F.col("size") if "size" in ticks.columns else F.lit(None)
    t = clean_ticks(ticks).select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq", "price", size.cast("bigint").alias("size"))
    at = F.struct("ts", "seq")
    return (t.groupBy("symbol", floor_to("ts", unit).alias("minute_ts"))
             .agg(F.min_by("price", at).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
                  F.max_by("price", at).alias("close_price"), F.count(F.lit(1)).alias("volume"), F.count(F.lit(1)).alias("tick_count"),
                  F.sum("size").alias("traded_size"), F.min(at).alias("_first"), F.max(at).alias("_last"))
             .select(*_KEYS, "open_price", "high_price", "low_price", "close_price", "volume", "tick_count", "traded_size",
                     F.col("_first.ts").alias("first_ts"), F.col("_first.seq").alias("first_seq"),
                     F.col("_last.ts").alias("last_ts"), F.col("_last.seq").alias("last_seq")))


def merged(parts: DataFrame) -> DataFrame:
    """One partial bar per key."""
    first, last = F.struct("first_ts", "first_seq"), F.struct("last_ts", "last_seq")
    return (parts.groupBy(*_KEYS)
                 .agg(F.min_by("open_price", first).alias("open_price"), F.max("high_price").alias("high_price"),
                      F.min("low_price").alias("low_price"), F.max_by("close_price", last).alias("close_price"),
                      F.sum("volume").alias("volume"), F.sum("tick_count").alias("tick_count"), F.sum("traded_size").alias("traded_size"),
                      F.min(first).alias("_first"), F.max(last).alias("_last"))
                 .select(*_KEYS, "open_price", "high_price", "low_price", "close_price", "volume", "tick_count", "traded_size",
                         F.col("_first.first_ts").alias("first_ts"), F.col("_first.first_seq").alias("first_seq"),
                         F.col("_last.last_ts").alias("last_ts"), F.col("_last.last_seq").alias("last_seq")))


def _complete(spark: SparkSession, table: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``kind=<number>``, in order."""
    names = [f for f in folders(spark, table) if f.startswith(kind + "=")]
    return sorted(int(f.split("=")[1]) for f in names if path_exists(spark, os.path.join(table, f, "_SUCCESS")))


def _days(spark: SparkSession, folder: str) -> list[str]:
    return [f for f in folders(spark, folder) if f.startswith("bar_day=")]


def _layout(spark: SparkSession, table: str) -> tuple[dict[str, str], dict[str, list[str]], int, int]:
    """(newest base folder of each day, part folders of each day, newest base, newest part)."""
    bases, parts = _complete(spark, table, "base"), _complete(spark, table, "part")
    newest = bases[-1] if bases else -1
    base = {day: os.path.join(table, f"base={k}", day) for k in bases for day in _days(spark, os.path.join(table, f"base={k}"))}
    fresh: dict[str, list[str]] = {}
    for k in (k for k in parts if k > newest):
        for day in _days(spark, os.path.join(table, f"part={k}")):
            fresh.setdefault(day, []).append(os.path.join(table, f"part={k}", day))
    return base, fresh, newest, parts[-1] if parts else -1


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], PART_SCHEMA)


def newest_base(spark: SparkSession, table: str) -> int:
    """The last batch that a base holds (-1: none)."""
    return max(_complete(spark, table, "base"), default=-1)


def _write(parts: DataFrame, path: str) -> None:
    parts.withColumn("bar_day", F.to_date("minute_ts")).write.mode("overwrite").partitionBy("bar_day").parquet(path)


def add(parts: DataFrame, table: str, batch: int) -> None:
    """Add the partial bars of batch ``batch`` (numbers increase); a batch that a base holds already changes nothing."""
    if batch > newest_base(parts.sparkSession, table):
        _write(parts, os.path.join(table, f"part={batch}"))


def compact(spark: SparkSession, table: str) -> None:
    """Merge all parts into a new base of the days they touch."""
    base, fresh, _, last = _layout(spark, table)
    if fresh:
        paths = [p for day, ps in fresh.items() for p in (*ps, *([base[day]] if day in base else []))]
        _write(merged(_read(spark, paths)), os.path.join(table, f"base={last}"))


def read_bars(spark: SparkSession, table: str, day_from: dt.date | None = None) -> DataFrame:
    """The bars by now (BAR_COLS and traded_size); ``day_from`` reads the folders of later days only."""
    base, fresh, _, _ = _layout(spark, table)
    wanted = lambda day: day_from is None or day.split("=")[1] >= str(day_from)
    quiet = [p for day, p in base.items() if wanted(day) and day not in fresh]
    busy = [p for day, ps in fresh.items() if wanted(day) for p in (*ps, *([base[day]] if day in base else []))]
    cols = [*BAR_COLS, "traded_size"]
    return _read(spark, quiet).select(cols).unionByName(merged(_read(spark, busy)).select(cols))
