"""Date and time expressions (all JVM-side column expressions).

The reference truncates timestamps before comparing them (``TRUNC(ts) = d``),
which hides the column from range pruning.  ``day_range`` writes the same
test as a half-open interval on the raw column so Parquet min/max statistics
and partition pruning still apply.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def day_range(ts, day) -> Column:
    """``TRUNC(ts) = day`` as ``ts >= day AND ts < day + 1`` (keeps pushdown)."""
    d = as_date(day)
    lo = dt.datetime.combine(d, dt.time())
    hi = lo + dt.timedelta(days=1)
    c = _col(ts)
    return (c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.lit(hi).cast("timestamp_ntz"))


def since(ts, start) -> Column:
    """``ts >= TRUNC(start)`` on a timestamp column."""
    lo = dt.datetime.combine(as_date(start), dt.time())
    return _col(ts) >= F.lit(lo).cast("timestamp_ntz")


def floor_to(ts, unit: str) -> Column:
    """Truncate to ``minute`` / ``hour`` / ``day``, keeping a zone-less timestamp."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def minute_floor(ts) -> Column:
    return floor_to(ts, "minute")


def epoch_to_ts(seconds) -> Column:
    """Epoch seconds (the tick message ``ts``) to a zone-less timestamp."""
    return F.timestamp_seconds(_col(seconds)).cast("timestamp_ntz")


def seconds_of_day(ts) -> Column:
    c = _col(ts)
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def hhmm_to_seconds(hhmm: str) -> int:
    h, m = hhmm.split(":")
    return int(h) * 3600 + int(m) * 60


def date_parts(d, dtype: str = "int") -> list[Column]:
    """year, quarter, month, day of a date (EXTRACT / TO_CHAR(d,'Q'))."""
    c = _col(d)
    return [F.year(c).cast(dtype).alias("year"), F.quarter(c).cast(dtype).alias("quarter"),
            F.month(c).cast(dtype).alias("month"), F.dayofmonth(c).cast(dtype).alias("day")]
