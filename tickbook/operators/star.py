"""Star-schema load from the staging table: dim_symbol, dim_date,
fact_price_daily (insert-if-absent) and fact_price_monthly (upsert).

Surrogate keys continue after the current maximum, numbered in key order by
the parallel ``with_global_index`` (no single-partition window), for the
new distinct dimension members as for the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_parts
from ..functions.ids import with_global_index
from ..session import scratch_path
from .staging import load_order
from .upsert import dedupe_latest, upsert

DIM_SYMBOL_COLS = ["symbol_id", "symbol", "company_name"]
DIM_DATE_COLS = ["date_id", "trade_date", "year", "quarter", "month", "day"]
FACT_DAILY_COLS = ["fact_id", "symbol_id", "date_id", "open_price", "high_price", "low_price",
                   "close_price", "adj_close", "volume"]
MONTHLY_KEYS = ["symbol_id", "year", "month"]


def _next_id(existing: DataFrame | None, id_col: str):
    if existing is None:
        return F.lit(0).cast("bigint")
    return existing.select(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


def _written(distinct: DataFrame, label: str) -> DataFrame:
    """The few distinct members, written once, so that the numbering is sized by their own count."""
    path = scratch_path(distinct.sparkSession, label)
    distinct.write.parquet(path)
    return distinct.sparkSession.read.schema(distinct.schema).parquet(path)


def load_dim_symbol(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """MERGE dim_symbol: insert unseen symbols; company_name = symbol + ' Inc.'."""
    new = staging.select("symbol").where(F.col("symbol").isNotNull()).distinct()
    if existing is not None:
        new = new.join(existing.select("symbol"), "symbol", "left_anti")
    base = _next_id(existing, "symbol_id")
    added = with_global_index(_written(new, "new-symbols"), ["symbol"], "symbol_id", start=base + 1).select(
        "symbol_id", "symbol", F.concat(F.col("symbol"), F.lit(" Inc.")).alias("company_name"))
    return added if existing is None else existing.select(*DIM_SYMBOL_COLS).unionByName(added)


def load_dim_date(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """MERGE dim_date: insert unseen trade dates with year/quarter/month/day."""
    new = staging.select("trade_date").where(F.col("trade_date").isNotNull()).distinct()
    if existing is not None:
        new = new.join(existing.select("trade_date"), "trade_date", "left_anti")
    base = _next_id(existing, "date_id")
    added = with_global_index(_written(new, "new-dates"), ["trade_date"], "date_id", start=base + 1).select(
        "date_id", "trade_date", *date_parts("trade_date"))
    return added if existing is None else existing.select(*DIM_DATE_COLS).unionByName(added)


def fact_rows(staging: DataFrame, dim_symbol: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Staging rows keyed by the surrogate keys (inner joins, as the reference).

    Duplicate (symbol, date) staging rows are reduced to the last one first (``LOAD_ORDER``)."""
    s = staging
    if load_order(s):
        s = dedupe_latest(s, ["symbol", "trade_date"], load_order(s))
    return (s.join(dim_symbol.select("symbol", "symbol_id"), "symbol")
             .join(dim_date.select("trade_date", "date_id"), "trade_date")
             .select("symbol_id", "date_id", "open_price", "high_price", "low_price", "close_price",
                     "adj_close", "volume"))


def load_fact_daily(staging: DataFrame, dim_symbol: DataFrame, dim_date: DataFrame,
                    existing: DataFrame | None = None) -> DataFrame:
    """INSERT INTO fact_price_daily ... WHERE NOT EXISTS (same symbol_id, date_id)."""
    rows = fact_rows(staging, dim_symbol, dim_date)
    if existing is not None:
        rows = rows.join(existing.select("symbol_id", "date_id"), ["symbol_id", "date_id"], "left_anti")
    base = _next_id(existing, "fact_id")
    # at most one fact row per staging row: the staging count bounds the input
    added = with_global_index(rows, ["date_id", "symbol_id"], "fact_id", start=base + 1,
                              rows_hint=staging.count()).select(*FACT_DAILY_COLS)
    return added if existing is None else existing.select(*FACT_DAILY_COLS).unionByName(added)


def monthly_rows(staging: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Monthly averages per symbol, of the prices as the daily fact has them (unrounded)."""
    s = staging.join(dim_symbol.select("symbol", "symbol_id"), "symbol")
    return (s.groupBy("symbol_id", F.year("trade_date").alias("year"), F.month("trade_date").alias("month"))
             .agg(F.avg("open_price").alias("avg_open"), F.avg("close_price").alias("avg_close"),
                  F.avg("high_price").alias("avg_high"), F.avg("low_price").alias("avg_low"),
                  F.sum("volume").cast("bigint").alias("total_volume")))


def load_fact_monthly(staging: DataFrame, dim_symbol: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """fact_price_monthly, upserted by (symbol_id, year, month) so a rerun adds no duplicates."""
    rows = monthly_rows(staging, dim_symbol)
    return rows if existing is None else upsert(existing, rows, MONTHLY_KEYS)


def price_upsert(fact_price: DataFrame, staging: DataFrame, load_date=None) -> DataFrame:
    """load_historical_prices(load_date): MERGE staging into fact_price by
    (symbol, price_date); all staged days when ``load_date`` is None."""
    s = staging
    if load_date is not None:
        s = s.filter(F.col("trade_date") == F.lit(load_date).cast("date"))
    if load_order(s):
        s = dedupe_latest(s, ["symbol", "trade_date"], load_order(s))
    src = s.select("symbol", F.col("trade_date").alias("price_date"), "open_price", "high_price", "low_price",
                   "close_price", "adj_close", "volume")
    return upsert(fact_price, src, ["symbol", "price_date"])
