"""Dashboard and API reports: top traded symbols, latest prices, P&L,
portfolio, recent risk, price history and tick range scans.

Lookups of "the latest close per symbol" are written as one aggregate
(``max_by``) followed by a left join instead of the reference's doubly
correlated scalar subquery: one pass over the prices, one row per symbol, and
AQE turns the join into a broadcast only when that side measures small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import as_date, day_range, hhmm_to_seconds, minute_floor, seconds_of_day, since
from .settlement import TOTAL

# Fixed values from the reference's business rules.
MAX_POSITION_USD = 1_000_000
MAX_DAILY_LOSS_USD = 50_000
VOLATILITY_LIMIT = 0.05
SESSION_OPEN, SESSION_CLOSE = "09:30", "16:00"


def top_traded(trades: DataFrame, day=None, n: int | None = None) -> DataFrame:
    """Quantity and value traded per symbol (one day, or all), largest first."""
    t = trades if day is None else trades.filter(day_range("trade_time", day))
    out = (t.groupBy("symbol")
            .agg(F.sum("quantity").cast("bigint").alias("total_qty"),
                 F.sum(F.col("quantity") * F.col("trade_price")).cast(TOTAL).alias("total_value"))
            .orderBy(F.col("total_qty").desc(), F.col("symbol")))
    return out.limit(n) if n else out


def latest_price(prices: DataFrame) -> DataFrame:
    """Last close per symbol: symbol, price_date, close_price."""
    return (prices.groupBy("symbol")
                  .agg(F.max("price_date").alias("price_date"),
                       F.max_by("close_price", "price_date").alias("close_price")))


def unrealized_pnl(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """quantity x (latest close - average cost); NULL price when the symbol has no history."""
    last = latest_price(prices).select("symbol", F.col("close_price").alias("current_price"))
    h = holdings.join(last, "symbol", "left")
    return h.select("customer_id", "symbol", "quantity", "average_cost", "current_price",
                    (F.col("quantity") * (F.col("current_price").cast("double") - F.col("average_cost")))
                    .alias("unrealized_pnl"))


def customer_pnl(spark: SparkSession, holdings: DataFrame, prices: DataFrame, customer_id: int) -> DataFrame:
    """The reference's per-customer P&L report with a bind parameter."""
    return spark.sql("SELECT * FROM {pnl} WHERE customer_id = :customer_id",
                     args={"customer_id": customer_id}, pnl=unrealized_pnl(holdings, prices))


def portfolio(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Positions of every customer with the latest close and market value (ours)."""
    last = latest_price(prices).select("symbol", F.col("close_price").alias("current_price"))
    return (holdings.join(last, "symbol", "left")
                    .select("customer_id", "symbol", "quantity", "average_cost", "current_price",
                            (F.col("quantity") * F.col("current_price")).cast(TOTAL).alias("market_value")))


def breach_position(holdings: DataFrame, prices: DataFrame, limit: int = MAX_POSITION_USD) -> DataFrame:
    """Positions whose absolute market value exceeds the limit (ours: |q x last close| > limit)."""
    p = portfolio(holdings, prices)
    return (p.filter(F.abs(F.col("market_value")) > F.lit(limit))
             .select("customer_id", "symbol", "quantity", "current_price",
                     F.col("market_value").alias("position_value")))


def daily_pnl(trades: DataFrame, prices: DataFrame) -> DataFrame:
    """Day-over-day mark-to-market P&L per customer (ours; the reference only names the limit).

    Per (customer, symbol) and trading day of that pair: position = running
    net quantity (buys +, sells -), value = position x the last close at or
    before that day, and P&L = value - value on the pair's previous trading
    day + the day's cash flow (sells receive, buys pay quantity x price).
    Summed per customer and day.  A day without a price keeps the position; a
    symbol without any price so far is valued at 0.  Exact decimal arithmetic;
    the windows hold one row per trading day of a pair, or per day of a
    symbol, which the calendar bounds."""
    day = _pair_days(trades)
    w = Window.partitionBy("customer_id", "symbol").orderBy("trade_date")
    held = day.withColumn("position", F.sum("dq").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    marked = held.join(_closes(day, prices), ["symbol", "trade_date"], "left").withColumn(
        "mtm", F.coalesce(F.col("position") * F.col("close_price"), F.lit(0)))
    pnl = (F.col("mtm") - F.coalesce(F.lag("mtm").over(w), F.lit(0)) + F.col("cash"))
    per_pair = marked.select("customer_id", "trade_date", pnl.alias("pnl"))
    return per_pair.groupBy("customer_id", "trade_date").agg(F.sum("pnl").cast(TOTAL).alias("daily_pnl"))


def _pair_days(trades: DataFrame) -> DataFrame:
    """Net quantity and cash flow per customer, symbol and trading day."""
    value = F.col("quantity") * F.col("trade_price")
    legs = (trades.select(F.col("buyer_id").alias("customer_id"), "symbol", "trade_time",
                          F.col("quantity").alias("dq"), (-value).alias("cash"))
                  .unionByName(trades.select(F.col("seller_id").alias("customer_id"), "symbol", "trade_time",
                                             (-F.col("quantity")).alias("dq"), value.alias("cash"))))
    return (legs.groupBy("customer_id", "symbol", F.to_date("trade_time").alias("trade_date"))
                .agg(F.sum("dq").alias("dq"), F.sum("cash").alias("cash")))


def _closes(days: DataFrame, prices: DataFrame) -> DataFrame:
    """symbol, trade_date, close_price: the last close at or before every traded day."""
    known = prices.select("symbol", F.col("price_date").alias("trade_date"), "close_price")
    both = days.select("symbol", "trade_date").distinct().join(known, ["symbol", "trade_date"], "full")
    w = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("symbol", "trade_date", F.last("close_price", ignorenulls=True).over(w).alias("close_price"))


def daily_loss_as_of(trades: DataFrame, prices: DataFrame, as_of) -> DataFrame:
    """P&L of one day for every customer with a position or a trade, traded that day
    or not: position at the previous close x the price change, plus the day's
    trades marked at the day's close.  customer_id, daily_pnl."""
    day = F.lit(as_date(as_of)).cast("date")
    rows = _pair_days(trades).where(F.col("trade_date") <= day)
    old = F.col("trade_date") < day
    pairs = rows.groupBy("customer_id", "symbol").agg(
        F.sum(F.when(old, F.col("dq")).otherwise(0)).alias("before"), F.sum("dq").alias("after"),
        F.sum(F.when(old, F.lit(0)).otherwise(F.col("cash"))).alias("cash"))
    known = prices.where((F.col("price_date") <= day) & F.col("close_price").isNotNull())
    last = known.groupBy("symbol").agg(
        F.max_by("close_price", "price_date").alias("now"),
        F.max_by(F.when(F.col("price_date") < day, F.col("close_price")),
                 F.when(F.col("price_date") < day, F.col("price_date"))).alias("prev"))
    zero = F.lit(0)
    value = (F.coalesce(F.col("after") * F.col("now"), zero) - F.coalesce(F.col("before") * F.col("prev"), zero) + F.col("cash"))
    return (pairs.join(last, "symbol", "left").groupBy("customer_id").agg(F.sum(value).cast(TOTAL).alias("daily_pnl")))


def breach_daily_loss(trades: DataFrame, prices: DataFrame, limit: int = MAX_DAILY_LOSS_USD) -> DataFrame:
    """Customer-days whose mark-to-market loss exceeds ``limit`` (see ``daily_pnl``)."""
    return daily_pnl(trades, prices).filter(F.col("daily_pnl") < -F.lit(limit))


def risk_recent(risk_daily: DataFrame, as_of) -> DataFrame:
    """Risk rows from the day before ``as_of`` on, highest score first."""
    start = as_date(as_of) - dt.timedelta(days=1)
    return (risk_daily.filter(since("risk_ts", start))
                      .select("symbol", "risk_ts", "risk_score")
                      .orderBy(F.col("risk_score").desc(), "symbol", "risk_ts"))


def price_history(prices: DataFrame, as_of, months: int = 12, symbol: str | None = None) -> DataFrame:
    """Daily prices in the period (as_of - months, as_of], optionally of one symbol."""
    end = as_date(as_of)
    start = F.add_months(F.lit(end), -months)
    p = prices.filter((F.col("price_date") > start) & (F.col("price_date") <= F.lit(end)))
    if symbol is not None:
        p = p.filter(F.col("symbol") == symbol)
    return p


def ticks_from(ticks: DataFrame, start, symbol: str | None = None) -> DataFrame:
    t = ticks.filter(since("ts", start))
    return t if symbol is None else t.filter(F.col("symbol") == symbol)


def in_session(df: DataFrame, ts_col: str, open_hhmm: str = SESSION_OPEN,
               close_hhmm: str = SESSION_CLOSE) -> DataFrame:
    """Rows whose ``ts_col`` falls inside trading hours [open, close) (ticks, orders)."""
    s = seconds_of_day(ts_col)
    return df.filter((s >= hhmm_to_seconds(open_hhmm)) & (s < hhmm_to_seconds(close_hhmm)))


def ticks_in_session(ticks: DataFrame, open_hhmm: str = SESSION_OPEN, close_hhmm: str = SESSION_CLOSE) -> DataFrame:
    """Ticks inside trading hours [open, close)."""
    return in_session(ticks, "ts", open_hhmm, close_hhmm)


def minute_volume(ticks: DataFrame) -> DataFrame:
    """Market-wide activity per minute: ticks, traded size, symbols."""
    return (ticks.groupBy(minute_floor("ts").alias("minute_ts"))
                 .agg(F.count(F.lit(1)).alias("tick_count"),
                      F.sum("size").cast("bigint").alias("total_size"),
                      F.count_distinct("symbol").alias("symbols")))
