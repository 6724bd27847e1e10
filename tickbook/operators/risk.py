"""Risk measures.

``risk_rolling`` is the stream risk engine as a batch plan: per symbol, the
sample standard deviation (x1000) of the last 200 prices, emitted at the
50th, 100th, 150th tick and at every tick from the 200th on (a deque of 200
whose length is tested against a stride of 50).

``risk_daily`` folds the emissions into the (symbol, day) keyed table the
reference MERGEs into: the first emission time of the day stays, the score
is the day's last.

``daily_returns`` / ``volatility`` / ``var95`` are our definitions of the
promised (but unimplemented) measures, over the daily closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import running_sums
from .bars import clean_ticks

# Fixed values of the reference's risk engine.
WINDOW_SIZE = 200
STRIDE = 50
MODEL_VERSION = "v1"
# ours: decimals of a price in the exact running sums
PRICE_SCALE = 6


def risk_rolling(ticks: DataFrame, window: int = WINDOW_SIZE, stride: int = STRIDE, sliced: bool | None = None) -> DataFrame:
    """Rolling score at the emission points, O(1) per tick whatever the window.

    A symbol's ticks get running counts, sums of the price and sums of its
    square (skew-proof, see ``running_sums``), in exact decimals, so nothing is
    lost when the sums ``window`` ticks back are subtracted again.  Those come
    by an equi-join on (symbol, tick number), a unique key, so a hot
    symbol spreads over all tasks.  Prices are taken to ``PRICE_SCALE``
    decimals and must be below 10^9; the squares of 10^14 ticks of price 1,000
    fit their sum."""
    price = F.col("price").cast(f"decimal(18,{PRICE_SCALE})")
    base = clean_ticks(ticks).select("symbol", "ts", "seq", price.alias("_p"))
    square = (F.col("_p") * F.col("_p")).cast(f"decimal(38,{2 * PRICE_SCALE})")
    sums = running_sums(base, ["symbol"], ["ts", "seq"], {"tick_no": F.lit(1).cast("bigint"), "_s1": F.col("_p"), "_s2": square},
                        label="risk-moments", materialize=True, sliced=sliced)
    emit = (F.col("tick_no") >= stride) & ((F.col("tick_no") >= window) | (F.col("tick_no") % stride == 0))
    before = sums.select(F.col("symbol").alias("_symbol"), (F.col("tick_no") + window).alias("_tick"),
                         F.col("_s1").alias("_b1"), F.col("_s2").alias("_b2"))
    now = sums.filter(emit).join(before, (F.col("symbol") == F.col("_symbol")) & (F.col("tick_no") == F.col("_tick")), "left")
    zero = F.lit(0).cast("decimal(1,0)")
    n = F.least(F.col("tick_no"), F.lit(window)).cast("decimal(6,0)")
    s1 = (F.col("_s1") - F.coalesce("_b1", zero)).cast(f"decimal(18,{PRICE_SCALE})")
    s2 = (F.col("_s2") - F.coalesce("_b2", zero)).cast(f"decimal(31,{2 * PRICE_SCALE})")
    spread = (n * s2 - s1 * s1).cast("double")                     # n (n - 1) times the sample variance
    count = n.cast("double")
    score = F.when(n < 2, F.lit(0.0)).otherwise(F.sqrt(spread / (count * (count - 1.0))) * 1000.0)
    return now.select("symbol", F.col("ts").alias("risk_ts"), "seq", "tick_no", score.alias("risk_score"))


def risk_daily(rolling: DataFrame) -> DataFrame:
    """fact_symbol_risk keyed by (symbol, day of risk_ts)."""
    order = F.struct("risk_ts", "seq")
    return (rolling.groupBy("symbol", F.to_date("risk_ts").alias("risk_day"))
                   .agg(F.min("risk_ts").alias("risk_ts"), F.max_by("risk_score", order).alias("risk_score"))
                   .select("symbol", "risk_ts", "risk_score", F.lit(MODEL_VERSION).alias("model_version")))


def daily_returns(prices: DataFrame) -> DataFrame:
    """close / previous close - 1 per symbol and trading day (a symbol's
    window holds one row per trading day: bounded by the calendar)."""
    w = Window.partitionBy("symbol").orderBy("price_date")
    close = F.col("close_price").cast("double")
    prev = F.lag(close).over(w)
    # a zero previous close has no return (try_divide: NULL, not an ANSI error)
    return (prices.select("symbol", "price_date", (F.try_divide(close, prev) - 1.0).alias("ret"))
                  .filter(F.col("ret").isNotNull()))


def volatility(prices: DataFrame) -> DataFrame:
    """Sample standard deviation of daily returns per symbol (ours)."""
    return (daily_returns(prices).groupBy("symbol")
            .agg(F.stddev_samp("ret").alias("volatility"), F.count(F.lit(1)).alias("n_returns")))


def var95(prices: DataFrame) -> DataFrame:
    """Historical 95% value at risk: minus the 5th percentile of daily returns (ours).

    ``percentile`` is exact and keeps one value per trading day of a symbol,
    which the calendar bounds."""
    return (daily_returns(prices).groupBy("symbol")
            .agg((-F.percentile("ret", F.lit(0.05))).alias("var_95"), F.count(F.lit(1)).alias("n_returns")))


def breach_volatility(prices: DataFrame, limit: float = 0.05) -> DataFrame:
    return volatility(prices).filter(F.col("volatility") > limit)


def merge_risk(fact_symbol_risk: DataFrame, daily: DataFrame) -> DataFrame:
    """The reference's risk MERGE, keyed by (symbol, day of risk_ts): a matched
    day gets the new score and model version, its first risk_ts stays."""
    from .upsert import upsert
    key = F.to_date("risk_ts").alias("risk_day")
    tgt = fact_symbol_risk.select("*", key)
    src = daily.select("symbol", "risk_ts", "risk_score", "model_version", key)
    return upsert(tgt, src, ["symbol", "risk_day"], update_cols=["risk_score", "model_version"]).drop("risk_day")
