"""Trade totals per symbol and day, daily settlement and the cash ledger.

``settle`` recomputes one day's totals from the trades and upserts them into
``fact_trade_agg`` keyed by (symbol, trade_date); rerunning it for the same day
leaves the table unchanged.  The aggregate is a two-phase hash aggregate
(partial sums before the shuffle), so a hot symbol costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_range
from ..functions.ids import with_global_index
from ..session import scratch_path
from .upsert import upsert

TOTAL = "decimal(38,2)"


def trade_totals(trades: DataFrame, day=None) -> DataFrame:
    """symbol, trade_date, total_qty, total_value for all days or one day."""
    t = trades if day is None else trades.filter(day_range("trade_time", day))
    return (t.groupBy("symbol", F.to_date("trade_time").alias("trade_date"))
             .agg(F.sum("quantity").cast("bigint").alias("total_qty"),
                  F.sum(F.col("quantity") * F.col("trade_price")).cast(TOTAL).alias("total_value")))


def settle(fact_trade_agg: DataFrame, trades: DataFrame, day) -> DataFrame:
    """run_daily_settlement(day): replace or insert the day's totals."""
    return upsert(fact_trade_agg, trade_totals(trades, day), ["symbol", "trade_date"])


def settlement_log(trades: DataFrame) -> DataFrame:
    """One COMPLETED row per settled trading day (fact_settlement), ids in day order."""
    days = trades.select(F.to_date("trade_time").alias("settlement_date")).distinct()
    path = scratch_path(trades.sparkSession, "settled-days")   # one row per day: the numbering is sized by these
    days.write.parquet(path)
    days = trades.sparkSession.read.schema(days.schema).parquet(path)
    return with_global_index(days, ["settlement_date"], "settlement_id").select(
        "settlement_id", "settlement_date", F.lit("COMPLETED").alias("status"))


def ledger_daily(trades: DataFrame, customers: DataFrame) -> DataFrame:
    """Daily cash flow per customer and the running account balance.

    Our definition (the reference only promises "daily P&L to the account
    ledger"): a buy pays quantity x price, a sell receives it; the balance
    starts at ``cash_balance`` and accumulates the daily flows.  The running
    sum is partitioned by customer and ordered by day, so a window holds at
    most one row per trading day of one customer.
    """
    value = (F.col("quantity") * F.col("trade_price"))
    legs = (trades.select(F.col("buyer_id").alias("customer_id"), "trade_time", (-value).alias("flow"))
                  .unionByName(trades.select(F.col("seller_id").alias("customer_id"), "trade_time",
                                             value.alias("flow"))))
    daily = (legs.groupBy("customer_id", F.to_date("trade_time").alias("trade_date"))
                 .agg(F.sum("flow").cast(TOTAL).alias("cash_flow")))
    w = Window.partitionBy("customer_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return (daily.join(customers.select("customer_id", "cash_balance"), "customer_id", "left")
                 .select("customer_id", "trade_date", "cash_flow",
                         (F.coalesce(F.col("cash_balance"), F.lit(0)) + F.sum("cash_flow").over(w))
                         .cast(TOTAL).alias("balance")))
