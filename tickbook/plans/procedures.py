"""The procedures of the trading schema, callable from SQL.

``install`` declares the tables as temporary views and over them SQL table
functions with parameters, so that a dashboard needs only SQL:

    SELECT * FROM customer_pnl(17)
    SELECT * FROM top_traded(DATE'2001-11-04')
    SELECT * FROM price_history('Brand#11', DATE'2001-11-04', 12)

A function is expanded into the query that calls it, so its parameters become
filters of the plan: a customer's filter goes below the holdings fold to both
sides of the trades, a day becomes a range on the raw time of the trades, a
symbol reaches the price scan.

``settlement_script`` is ``run_daily_settlement`` as a SQL script over tables
in the catalog: it checks the day, replaces or adds its totals, and notes it
in the log once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.holdings import holdings

_VIEWS = {"trades": "trading_trades", "prices": "trading_prices", "holdings": "trading_holdings"}

_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION customer_pnl(customer BIGINT)
    RETURNS TABLE (customer_id BIGINT, symbol STRING, quantity BIGINT, average_cost DOUBLE, current_price DECIMAL(18,2),
                   unrealized_pnl DOUBLE)
    RETURN SELECT h.customer_id, h.symbol, h.quantity, h.average_cost, p.current_price,
                  h.quantity * (CAST(p.current_price AS DOUBLE) - h.average_cost)
           FROM {holdings} h
           LEFT JOIN (SELECT symbol, max_by(close_price, price_date) AS current_price FROM {prices} GROUP BY symbol) p
             ON p.symbol = h.symbol
           WHERE h.customer_id = customer""",
    """CREATE OR REPLACE TEMPORARY FUNCTION top_traded(day DATE)
    RETURNS TABLE (symbol STRING, total_qty BIGINT, total_value DECIMAL(38,2))
    RETURN SELECT t.symbol, CAST(sum(t.quantity) AS BIGINT), CAST(sum(t.quantity * t.trade_price) AS DECIMAL(38,2))
           FROM {trades} t
           WHERE t.trade_time >= CAST(day AS TIMESTAMP_NTZ) AND t.trade_time < CAST(date_add(day, 1) AS TIMESTAMP_NTZ)
           GROUP BY t.symbol""",
    """CREATE OR REPLACE TEMPORARY FUNCTION price_history(of_symbol STRING, as_of DATE, months INT)
    RETURNS TABLE (symbol STRING, price_date DATE, open_price DECIMAL(18,2), high_price DECIMAL(18,2), low_price DECIMAL(18,2),
                   close_price DECIMAL(18,2), volume BIGINT)
    RETURN SELECT p.symbol, p.price_date, p.open_price, p.high_price, p.low_price, p.close_price, p.volume
           FROM {prices} p
           WHERE p.symbol = of_symbol AND p.price_date > add_months(as_of, -months) AND p.price_date <= as_of""",
)

_SETTLEMENT = """
BEGIN
  DECLARE run_day DATE DEFAULT DATE'{day}';
  DECLARE first_time TIMESTAMP_NTZ DEFAULT CAST(DATE'{day}' AS TIMESTAMP_NTZ);
  DECLARE next_time TIMESTAMP_NTZ DEFAULT CAST(date_add(DATE'{day}', 1) AS TIMESTAMP_NTZ);
  DECLARE found BIGINT DEFAULT 0;
  DECLARE logged BIGINT DEFAULT 0;
  SET found = (SELECT count(*) FROM {trades} WHERE trade_time >= first_time AND trade_time < next_time);
  IF found > 0 THEN
    INSERT OVERWRITE TABLE {totals} PARTITION (trade_date)
    SELECT symbol, CAST(sum(quantity) AS BIGINT), CAST(sum(quantity * trade_price) AS DECIMAL(38,2)), run_day
    FROM {trades} WHERE trade_time >= first_time AND trade_time < next_time GROUP BY symbol;
  END IF;
  SET logged = (SELECT count(*) FROM {log} WHERE settlement_date = run_day);
  IF logged = 0 THEN
    INSERT INTO {log}
    SELECT (SELECT coalesce(max(settlement_id), 0) FROM {log}) + 1, run_day, 'COMPLETED';
  END IF;
  SELECT run_day AS settlement_date, found AS trades;
END"""


def install(spark: SparkSession, trades: DataFrame, prices: DataFrame, positions: DataFrame | None = None) -> None:
    """Declare the views and functions (``positions``: holdings kept elsewhere; else folded from the trades)."""
    trades.createOrReplaceTempView(_VIEWS["trades"])
    prices.createOrReplaceTempView(_VIEWS["prices"])
    (holdings(trades) if positions is None else positions).createOrReplaceTempView(_VIEWS["holdings"])
    for function in _FUNCTIONS:
        spark.sql(function.format(**_VIEWS))


def create_settlement_tables(spark: SparkSession, totals: str, log: str, folder: str) -> None:
    """The script's tables, below ``folder``: totals by day (a run replaces its own day) and the log."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {totals} (symbol STRING, total_qty BIGINT, total_value DECIMAL(38,2), trade_date DATE) "
              f"USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (trade_date) LOCATION '{folder}/totals'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {log} (settlement_id BIGINT, settlement_date DATE, status STRING) "
              f"USING parquet LOCATION '{folder}/log'")


def settlement_script(day, trades: str, totals: str, log: str) -> str:
    """``run_daily_settlement(day)`` as one SQL script for ``spark.sql``.

    A day may be settled again: its totals are replaced, its log row stays.  A day
    without trades is logged and leaves the totals as they are, as in the
    reference."""
    return _SETTLEMENT.format(day=day, trades=trades, totals=totals, log=log)
