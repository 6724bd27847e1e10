"""Cleansing of staged price rows (P1-P4) and the all-or-nothing staging load (S3).

Numbers that do not parse become NULL (``try_cast``; ANSI casts would
raise), a missing or unparsable volume becomes 0, and a row with any of the
five prices missing is not staged but routed to the rejects with the names
of the missing columns.  A NULL or empty symbol is rejected too (the
reference would store the text 'nan').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, replace_folder, scratch_path
from ..sources.price_files import POSITION_COLS, is_header_error, read_price_files, read_standard_files

PRICE_COLS = ["open_price", "high_price", "low_price", "close_price", "adj_close"]
_SOURCE = {"open_price": "open", "high_price": "high", "low_price": "low",
           "close_price": "close", "adj_close": "adj_close"}
STAGING_COLS = ["symbol", "trade_date", *PRICE_COLS, "volume"]
# Which of several rows with one key wins: the newest load, then the last file, then the last line.
LOAD_ORDER = ["load_ts", *POSITION_COLS]


def load_order(staging: DataFrame) -> list[str]:
    """The columns of ``LOAD_ORDER`` that a staging table has."""
    return [c for c in LOAD_ORDER if c in staging.columns]


def _num(c: str) -> Column:
    # try_cast: unparsable -> NULL; 'NaN' parses to NaN, which counts as missing
    v = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return F.nanvl(v, F.lit(None).cast("double"))


def typed(raw: DataFrame) -> DataFrame:
    """Raw CSV strings to typed columns; nothing dropped yet."""
    sym = F.trim(F.col("Symbol"))
    return raw.select(
        F.when(F.length(sym) > 0, sym).alias("symbol"),
        # a timestamp text keeps its day, whatever zone it names
        F.expr("CAST(try_cast(`date` AS TIMESTAMP_NTZ) AS DATE)").alias("trade_date"),
        *[_num(src).alias(dst) for dst, src in _SOURCE.items()],
        F.coalesce(_num("volume"), F.lit(0.0)).cast("bigint").alias("volume"),
        *[F.col(c) for c in POSITION_COLS if c in raw.columns],
    )


def _reason() -> Column:
    checks = [F.when(F.col("symbol").isNull(), F.lit("symbol")),
              F.when(F.col("trade_date").isNull(), F.lit("trade_date"))]
    checks += [F.when(F.col(c).isNull(), F.lit(c)) for c in PRICE_COLS]
    return F.concat_ws(",", *checks)


def _checked(raw: DataFrame) -> tuple[DataFrame, list[str]]:
    t = typed(raw)
    return t.withColumn("reason", _reason()), [*STAGING_COLS, *[c for c in POSITION_COLS if c in t.columns]]


def cleanse(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(staged rows, rejected rows with reason) from the raw CSV scan."""
    t, cols = _checked(raw)
    return t.filter(F.col("reason") == "").select(*cols), t.filter(F.col("reason") != "").select("symbol", "trade_date", "reason")


def load_staging(spark: SparkSession, raw: DataFrame, table_path: str | None = None, load_ts=None) -> tuple[str, str]:
    """Full refresh of the staging table (truncate + insert), all or nothing.

    The input is read and written once, split by a ``rejected`` folder: staged
    rows, with no ``reason``, in one, rejected rows in the other.  A table at
    ``table_path`` is replaced by renaming after that write succeeded, so a
    failing file leaves the previous one in place.  Returns (staged, rejects)."""
    t, cols = _checked(raw)
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    rows = t.select(*cols, ts.alias("load_ts"), F.nullif("reason", F.lit("")).alias("reason"))
    every = scratch_path(spark, "stg_historical_price")
    rows.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(every)
    parts = [f"{every}/rejected={flag}" for flag in ("false", "true")]
    for part in parts:
        if not path_exists(spark, part):
            spark.createDataFrame([], rows.schema).write.parquet(part)
    if table_path:
        replace_folder(spark, parts[0], table_path)
        parts[0] = table_path
    return parts[0], parts[1]


def load_price_files(spark: SparkSession, csv_dir: str, table_path: str | None = None, load_ts=None) -> tuple[str, str]:
    """``load_staging`` of a folder of price files, whose headers the reader checks as it reads.

    Only if some file has another layout is its own header scan made."""
    try:
        return load_staging(spark, read_standard_files(spark, csv_dir), table_path, load_ts)
    except Exception as e:
        if not is_header_error(e):
            raise
    return load_staging(spark, read_price_files(spark, csv_dir), table_path, load_ts)
