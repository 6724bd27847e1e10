"""Independent SQL (DuckDB dialect) for every registered query.

Each statement rebuilds its inputs from the raw tables with the adapter
definitions of FIXTURES.md §C and computes the answer the straightforward
way (interval-overlap join for matching, a recursive CTE for the holdings
fold), so it shares no code path with the Spark plans.
"""

from __future__ import annotations

import re

# ---- adapters --------------------------------------------------------------

LINES = """lines AS (
  SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS n,
         o_custkey, l_suppkey, p_brand, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""

TRADES = LINES + """,
trades AS (
  SELECT n AS trade_id, o_custkey AS buyer_id, l_suppkey AS seller_id, p_brand AS symbol,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS trade_price,
         l_shipdate AS trade_time
  FROM lines)"""

BOOK = LINES + """,
book AS (
  SELECT n AS order_id, o_custkey AS customer_id, p_brand AS symbol,
         CASE l_linestatus WHEN 'F' THEN 'BUY' ELSE 'SELL' END AS side,
         CAST(l_quantity AS BIGINT) AS quantity,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END AS filled_quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CASE l_returnflag WHEN 'N' THEN 'PENDING' WHEN 'A' THEN 'OPEN' ELSE 'FILLED' END AS status,
         l_shipdate AS created_at
  FROM lines)"""

PRICES = TRADES + """,
prices AS (
  SELECT symbol, CAST(trade_time AS DATE) AS price_date,
         arg_min(trade_price, trade_id) AS open_price, max(trade_price) AS high_price,
         min(trade_price) AS low_price, arg_max(trade_price, trade_id) AS close_price,
         arg_max(trade_price, trade_id) AS adj_close, CAST(sum(quantity) AS BIGINT) AS volume
  FROM trades GROUP BY symbol, CAST(trade_time AS DATE))"""

TICKS = """ticks AS (
  SELECT event_id AS seq, event_type AS symbol, ts, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["top_traded"] = w(TRADES) + """
SELECT symbol, CAST(sum(quantity) AS BIGINT) AS total_qty,
       CAST(sum(quantity * trade_price) AS DECIMAL(38,2)) AS total_value
FROM trades GROUP BY symbol ORDER BY total_qty DESC, symbol"""

OPEN = """open_orders AS (
  SELECT *, quantity - filled_quantity AS open_qty FROM book
  WHERE status IN ('PENDING', 'OPEN') AND side IN ('BUY', 'SELL')
    AND quantity - filled_quantity > 0 AND price IS NOT NULL AND symbol IS NOT NULL)"""

# price-time match as an interval-overlap join (independent of the sweep)
MATCH = OPEN + """,
mb AS (SELECT order_id, customer_id, symbol, price, open_qty,
              sum(open_qty) OVER (PARTITION BY symbol ORDER BY price DESC, created_at, order_id
                                  ROWS UNBOUNDED PRECEDING) AS hi
       FROM open_orders WHERE side = 'BUY'),
ms AS (SELECT order_id, customer_id, symbol, price, open_qty,
              sum(open_qty) OVER (PARTITION BY symbol ORDER BY price ASC, created_at, order_id
                                  ROWS UNBOUNDED PRECEDING) AS hi
       FROM open_orders WHERE side = 'SELL'),
mx AS (SELECT mb.symbol, mb.order_id AS buy_order_id, ms.order_id AS sell_order_id,
              mb.customer_id AS buyer_id, ms.customer_id AS seller_id,
              least(mb.hi, ms.hi) - greatest(mb.hi - mb.open_qty, ms.hi - ms.open_qty) AS quantity,
              ms.price AS trade_price, least(mb.hi, ms.hi) AS pos
       FROM mb JOIN ms ON mb.symbol = ms.symbol AND mb.price >= ms.price
        AND least(mb.hi, ms.hi) > greatest(mb.hi - mb.open_qty, ms.hi - ms.open_qty)),
matched AS (SELECT row_number() OVER (ORDER BY symbol, pos) AS trade_id, buy_order_id, sell_order_id,
                   buyer_id, seller_id, symbol, CAST(quantity AS BIGINT) AS quantity, trade_price FROM mx)"""

# price-time match without self-trades: the later order of each self-pair leaves the book, and
# the match is repeated; the rounds are written out (one more than the given tables need at any size tried)
NO_SELF_ROUNDS = 6


def _no_self() -> str:
    book = OPEN.replace("open_orders AS (", "open0 AS MATERIALIZED (")
    out = [book]
    for i in range(NO_SELF_ROUNDS):
        step = MATCH.removeprefix(OPEN + ",\n").replace("open_orders", f"open{i}")
        for name in ("matched", "mb", "ms", "mx"):
            step = re.sub(rf"\b{name}\b", f"{name}{i}", step)
        out.append(re.sub(rf"\b(m[bsx]{i}|matched{i}) AS \(", r"\1 AS MATERIALIZED (", step))
        out.append(f"""own{i} AS MATERIALIZED (
  SELECT DISTINCT m.symbol, CASE WHEN (b.created_at, b.order_id) > (s.created_at, s.order_id) THEN b.order_id ELSE s.order_id END AS order_id
  FROM mx{i} m JOIN open{i} b ON b.order_id = m.buy_order_id JOIN open{i} s ON s.order_id = m.sell_order_id
  WHERE m.buyer_id = m.seller_id),
open{i + 1} AS MATERIALIZED (SELECT * FROM open{i} o WHERE NOT EXISTS (SELECT 1 FROM own{i} c WHERE c.order_id = o.order_id))""")
    return ",\n".join(out)


# holdings fold as a recursive CTE over the legs of each (customer, symbol)
HOLDINGS = """legs AS (
  SELECT buyer_id AS customer_id, symbol, trade_id, 0 AS leg, quantity AS qty,
         CAST(trade_price AS DOUBLE) AS px FROM trades
  UNION ALL
  SELECT seller_id, symbol, trade_id, 1, quantity, CAST(trade_price AS DOUBLE) FROM trades),
first_buy AS (SELECT customer_id, symbol, min(trade_id) AS t0 FROM legs WHERE leg = 0 GROUP BY customer_id, symbol),
seq AS (SELECT l.*, row_number() OVER (PARTITION BY l.customer_id, l.symbol ORDER BY l.trade_id, l.leg) AS k
        FROM legs l JOIN first_buy f ON l.customer_id = f.customer_id AND l.symbol = f.symbol
        WHERE l.trade_id >= f.t0),
fold AS (SELECT customer_id, symbol, k, qty AS q, px AS avg FROM seq WHERE k = 1
  UNION ALL
  SELECT r.customer_id, r.symbol, s.k,
         CASE WHEN s.leg = 0 THEN r.q + s.qty ELSE r.q - s.qty END,
         CASE WHEN s.leg = 0 THEN
              CASE WHEN r.q + s.qty = 0 THEN NULL
                   ELSE (CAST(r.q AS DOUBLE) * coalesce(r.avg, 0.0) + CAST(s.qty AS DOUBLE) * s.px)
                        / CAST(r.q + s.qty AS DOUBLE) END
              ELSE r.avg END
  FROM fold r JOIN seq s ON s.customer_id = r.customer_id AND s.symbol = r.symbol AND s.k = r.k + 1),
holdings AS (SELECT customer_id, symbol, CAST(q AS BIGINT) AS quantity, avg AS average_cost FROM fold
             QUALIFY k = max(k) OVER (PARTITION BY customer_id, symbol))"""

LATEST = """latest AS (SELECT symbol, max(price_date) AS price_date,
                  arg_max(close_price, price_date) AS close_price FROM prices GROUP BY symbol)"""

RETURNS = """rets AS (SELECT symbol, price_date,
         CAST(close_price AS DOUBLE) / lag(CAST(close_price AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY price_date) - 1.0 AS ret
       FROM prices),
rets_nn AS (SELECT * FROM rets WHERE ret IS NOT NULL)"""

SETTLE = """
SELECT symbol, CAST(trade_time AS DATE) AS trade_date, CAST(sum(quantity) AS BIGINT) AS total_qty,
       CAST(sum(quantity * trade_price) AS DECIMAL(38,2)) AS total_value
FROM trades GROUP BY symbol, CAST(trade_time AS DATE)"""

SQL["top_traded_day"] = w(TRADES, "d AS (SELECT max(CAST(trade_time AS DATE)) AS day FROM trades)") + """
SELECT symbol, CAST(sum(quantity) AS BIGINT) AS total_qty,
       CAST(sum(quantity * trade_price) AS DECIMAL(38,2)) AS total_value
FROM trades WHERE trade_time >= (SELECT day FROM d) AND trade_time < (SELECT day FROM d) + INTERVAL 1 DAY
GROUP BY symbol ORDER BY total_qty DESC, symbol"""

SQL["settle_all"] = w(TRADES) + SETTLE
SQL["settle_day"] = w(TRADES) + SETTLE

SQL["settlement_status"] = w(TRADES) + """
SELECT row_number() OVER (ORDER BY d) AS settlement_id, d AS settlement_date, 'COMPLETED' AS status
FROM (SELECT DISTINCT CAST(trade_time AS DATE) AS d FROM trades)"""

SQL["holdings"] = "WITH RECURSIVE " + TRADES + ",\n" + HOLDINGS + "\nSELECT * FROM holdings"

SQL["ledger_daily"] = w(TRADES) + """,
flows AS (SELECT buyer_id AS customer_id, trade_time, -(quantity * trade_price) AS flow FROM trades
          UNION ALL SELECT seller_id, trade_time, quantity * trade_price FROM trades),
daily AS (SELECT customer_id, CAST(trade_time AS DATE) AS trade_date, CAST(sum(flow) AS DECIMAL(38,2)) AS cash_flow
          FROM flows GROUP BY customer_id, CAST(trade_time AS DATE))
SELECT d.customer_id, d.trade_date, d.cash_flow,
       CAST(coalesce(CAST(c.c_acctbal AS DECIMAL(18,2)), 0)
            + sum(d.cash_flow) OVER (PARTITION BY d.customer_id ORDER BY d.trade_date ROWS UNBOUNDED PRECEDING)
            AS DECIMAL(38,2)) AS balance
FROM daily d LEFT JOIN customer c ON c.c_custkey = d.customer_id"""

SQL["latest_price"] = w(PRICES, LATEST) + "SELECT * FROM latest"

SQL["unrealized_pnl"] = "WITH RECURSIVE " + PRICES + ",\n" + HOLDINGS + ",\n" + LATEST + """
SELECT h.customer_id, h.symbol, h.quantity, h.average_cost, l.close_price AS current_price,
       h.quantity * (CAST(l.close_price AS DOUBLE) - h.average_cost) AS unrealized_pnl
FROM holdings h LEFT JOIN latest l ON l.symbol = h.symbol"""

SQL["customer_pnl"] = SQL["unrealized_pnl"] + """
WHERE h.customer_id = (SELECT min(buyer_id) FROM trades)"""

SQL["portfolio"] = "WITH RECURSIVE " + PRICES + ",\n" + HOLDINGS + ",\n" + LATEST + """
SELECT h.customer_id, h.symbol, h.quantity, h.average_cost, l.close_price AS current_price,
       CAST(h.quantity * l.close_price AS DECIMAL(38,2)) AS market_value
FROM holdings h LEFT JOIN latest l ON l.symbol = h.symbol"""

SQL["breach_position"] = "WITH RECURSIVE " + PRICES + ",\n" + HOLDINGS + ",\n" + LATEST + """
SELECT customer_id, symbol, quantity, current_price, market_value AS position_value FROM (
  SELECT h.customer_id, h.symbol, h.quantity, l.close_price AS current_price,
         CAST(h.quantity * l.close_price AS DECIMAL(38,2)) AS market_value
  FROM holdings h LEFT JOIN latest l ON l.symbol = h.symbol)
WHERE abs(market_value) > 1000000"""

DAILY_PNL = """legs_pnl AS (
  SELECT buyer_id AS customer_id, symbol, trade_time, quantity AS dq, -(quantity * trade_price) AS cash FROM trades
  UNION ALL
  SELECT seller_id, symbol, trade_time, -quantity, quantity * trade_price FROM trades),
pair_day AS (
  SELECT customer_id, symbol, CAST(trade_time AS DATE) AS trade_date, sum(dq) AS dq, sum(cash) AS cash
  FROM legs_pnl GROUP BY customer_id, symbol, CAST(trade_time AS DATE)),
marked AS (
  SELECT d.*, sum(d.dq) OVER (PARTITION BY d.customer_id, d.symbol ORDER BY d.trade_date
                              ROWS UNBOUNDED PRECEDING) * p.close_price AS mtm
  FROM pair_day d JOIN prices p ON p.symbol = d.symbol AND p.price_date = d.trade_date),
pair_pnl AS (
  SELECT customer_id, trade_date,
         mtm - coalesce(lag(mtm) OVER (PARTITION BY customer_id, symbol ORDER BY trade_date), 0) + cash AS pnl
  FROM marked),
daily_pnl AS (
  SELECT customer_id, trade_date, CAST(sum(pnl) AS DECIMAL(38,2)) AS daily_pnl
  FROM pair_pnl GROUP BY customer_id, trade_date)"""

SQL["breach_daily_loss"] = w(PRICES, DAILY_PNL) + """
SELECT customer_id, trade_date, daily_pnl FROM daily_pnl WHERE daily_pnl < -50000"""

SQL["risk_volatility"] = w(PRICES, RETURNS) + """
SELECT symbol, round(stddev_samp(ret), 6) AS volatility, count(*) AS n_returns FROM rets_nn GROUP BY symbol"""

SQL["risk_var95"] = w(PRICES, RETURNS) + """
SELECT symbol, round(-quantile_cont(ret, 0.05), 6) AS var_95, count(*) AS n_returns FROM rets_nn GROUP BY symbol"""

SQL["breach_volatility"] = w(PRICES, RETURNS) + """
SELECT symbol, round(stddev_samp(ret), 6) AS volatility, count(*) AS n_returns FROM rets_nn GROUP BY symbol
HAVING stddev_samp(ret) > 0.05"""

SQL["price_history"] = w(PRICES) + """
SELECT * FROM prices
WHERE price_date > (SELECT max(price_date) FROM prices) - INTERVAL 12 MONTH
  AND price_date <= (SELECT max(price_date) FROM prices)"""

SQL["scalar_calendar"] = w(PRICES) + """
SELECT price_date, year(price_date) AS year, quarter(price_date) AS quarter, month(price_date) AS month,
       day(price_date) AS day, strftime(price_date, '%Y-%m-%d') AS date_text,
       CAST(price_date - INTERVAL 1 DAY AS DATE) AS prev_day,
       CAST(date_trunc('month', price_date) AS DATE) AS month_start
FROM (SELECT DISTINCT price_date FROM prices)"""

SQL["open_book"] = w(BOOK, OPEN) + "SELECT * FROM open_orders"

SQL["book_ranked"] = w(BOOK, OPEN) + """
SELECT order_id, symbol, side, price, open_qty,
       row_number() OVER w AS priority,
       CAST(sum(open_qty) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_qty
FROM open_orders
WINDOW w AS (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'BUY' THEN -price ELSE price END, created_at, order_id)"""

SQL["match_price_time"] = w(BOOK, MATCH) + "SELECT * FROM matched"

SQL["match_no_self"] = w(BOOK, _no_self()) + f"SELECT * FROM matched{NO_SELF_ROUNDS - 1}"

SQL["self_trade_cancels"] = w(BOOK, _no_self()) + " UNION ALL ".join(
    f"SELECT order_id, symbol FROM own{i}" for i in range(NO_SELF_ROUNDS))

SQL["match_best_buy"] = w(BOOK, OPEN) + """,
best AS (SELECT * FROM open_orders WHERE side = 'BUY'
         QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY price DESC, created_at, order_id) = 1)
SELECT b.order_id AS buy_order_id, s.order_id AS sell_order_id, b.customer_id AS buyer_id,
       s.customer_id AS seller_id, s.symbol, least(b.open_qty, s.open_qty) AS quantity, s.price AS trade_price
FROM best b JOIN open_orders s ON s.symbol = b.symbol AND s.side = 'SELL' AND b.price >= s.price"""

SQL["orders_after_match"] = w(BOOK, MATCH) + """,
fills AS (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS traded FROM (
            SELECT buy_order_id AS order_id, quantity FROM matched
            UNION ALL SELECT sell_order_id, quantity FROM matched) GROUP BY order_id)
SELECT o.order_id, o.customer_id, o.symbol, o.side, o.quantity,
       CASE WHEN f.traded IS NULL THEN o.filled_quantity ELSE o.filled_quantity + f.traded END AS filled_quantity,
       o.price,
       CASE WHEN f.traded IS NULL THEN o.status
            WHEN o.filled_quantity + f.traded >= o.quantity THEN 'FILLED' ELSE 'PARTIAL' END AS status,
       o.created_at
FROM book o LEFT JOIN fills f ON f.order_id = o.order_id"""

BARS = """
SELECT symbol, date_trunc('{unit}', ts) AS minute_ts,
       arg_min(price, (ts, seq)) AS open_price, max(price) AS high_price, min(price) AS low_price,
       arg_max(price, (ts, seq)) AS close_price, count(*) AS volume, count(*) AS tick_count{extra}
FROM ticks GROUP BY symbol, date_trunc('{unit}', ts)"""

SQL["ticks_clean"] = w(TICKS) + "SELECT * FROM ticks WHERE length(symbol) > 0 AND price IS NOT NULL"
SQL["bars_1m"] = w(TICKS) + BARS.format(unit="minute", extra="")
SQL["bars_1h"] = w(TICKS) + BARS.format(unit="hour", extra="")
SQL["bars_1m_size"] = w(TICKS) + BARS.format(unit="minute", extra=", CAST(sum(size) AS BIGINT) AS traded_size")

SQL["minute_volume"] = w(TICKS) + """
SELECT date_trunc('minute', ts) AS minute_ts, count(*) AS tick_count, CAST(sum(size) AS BIGINT) AS total_size,
       count(DISTINCT symbol) AS symbols
FROM ticks GROUP BY date_trunc('minute', ts)"""

ROLLING = """rolling AS (
  SELECT symbol, ts AS risk_ts, seq, tick_no, score FROM (
    SELECT symbol, ts, seq, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS tick_no,
           coalesce(stddev_samp(price) OVER (PARTITION BY symbol ORDER BY ts, seq
                                             ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 0) * 1000 AS score
    FROM ticks)
  WHERE tick_no >= 50 AND (tick_no >= 200 OR tick_no % 50 = 0))"""

RISK_DAILY = """risk_daily AS (
  SELECT symbol, min(risk_ts) AS risk_ts, round(arg_max(score, (risk_ts, seq)), 6) AS risk_score,
         'v1' AS model_version
  FROM rolling GROUP BY symbol, CAST(risk_ts AS DATE))"""

SQL["risk_rolling"] = w(TICKS, ROLLING) + """
SELECT symbol, risk_ts, seq, tick_no, round(score, 6) AS risk_score FROM rolling"""

SQL["risk_daily"] = w(TICKS, ROLLING, RISK_DAILY) + "SELECT * FROM risk_daily"

SQL["risk_recent"] = w(TICKS, ROLLING, RISK_DAILY) + """
SELECT symbol, risk_ts, risk_score FROM risk_daily
WHERE risk_ts >= (SELECT CAST(max(ts) AS DATE) FROM ticks) - INTERVAL 1 DAY
ORDER BY risk_score DESC, symbol, risk_ts"""

SQL["ticks_from"] = w(TICKS) + """
SELECT * FROM ticks WHERE ts >= (SELECT CAST(max(ts) AS DATE) FROM ticks) - INTERVAL 7 DAY"""

SQL["ticks_in_session"] = w(TICKS) + """
SELECT * FROM ticks
WHERE hour(ts) * 3600 + minute(ts) * 60 + second(ts) >= 34200
  AND hour(ts) * 3600 + minute(ts) * 60 + second(ts) < 57600"""

STAGED = PRICES + """,
staged AS (
  SELECT symbol, price_date AS trade_date, CAST(open_price AS DOUBLE) AS open_price,
         CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price,
         CAST(close_price AS DOUBLE) AS close_price, CAST(adj_close AS DOUBLE) AS adj_close,
         CASE WHEN dayofyear(price_date) % 31 = 11 THEN 0 ELSE volume END AS volume
  FROM prices WHERE dayofyear(price_date) % 31 NOT IN (7, 19))"""

SQL["stage_prices"] = w(STAGED) + "SELECT * FROM staged"

SQL["stage_rejects"] = w(PRICES) + """
SELECT symbol, price_date AS trade_date,
       CASE dayofyear(price_date) % 31 WHEN 7 THEN 'open_price' ELSE 'close_price' END AS reason
FROM prices WHERE dayofyear(price_date) % 31 IN (7, 19)"""

SQL["export_prices_roundtrip"] = w(PRICES) + """
SELECT price_date AS trade_date, symbol, symbol AS file_symbol, open_price, high_price, low_price,
       close_price, adj_close, volume FROM prices"""

DIMS = """syms AS (SELECT DISTINCT symbol FROM staged),
dim_symbol AS (SELECT row_number() OVER (ORDER BY symbol) AS symbol_id, symbol,
                      symbol || ' Inc.' AS company_name FROM syms),
dates AS (SELECT DISTINCT trade_date FROM staged),
dim_date AS (SELECT row_number() OVER (ORDER BY trade_date) AS date_id, trade_date,
                    CAST(year(trade_date) AS INTEGER) AS year, CAST(quarter(trade_date) AS INTEGER) AS quarter,
                    CAST(month(trade_date) AS INTEGER) AS month, CAST(day(trade_date) AS INTEGER) AS day FROM dates)"""

SQL["dim_symbol"] = w(STAGED, """syms AS (SELECT DISTINCT symbol FROM staged),
seed AS (SELECT row_number() OVER (ORDER BY symbol) AS symbol_id, symbol FROM syms WHERE symbol < 'Brand#2'),
added AS (SELECT (SELECT coalesce(max(symbol_id), 0) FROM seed) + row_number() OVER (ORDER BY symbol) AS symbol_id,
                 symbol FROM syms WHERE symbol NOT IN (SELECT symbol FROM seed))""") + """
SELECT symbol_id, symbol, symbol || ' Inc.' AS company_name FROM seed
UNION ALL SELECT symbol_id, symbol, symbol || ' Inc.' FROM added"""

SQL["dim_date"] = w(STAGED, """dates AS (SELECT DISTINCT trade_date FROM staged),
seed AS (SELECT row_number() OVER (ORDER BY trade_date) AS date_id, trade_date FROM dates
         WHERE trade_date < DATE '1998-01-01'),
added AS (SELECT (SELECT coalesce(max(date_id), 0) FROM seed) + row_number() OVER (ORDER BY trade_date) AS date_id,
                 trade_date FROM dates WHERE trade_date NOT IN (SELECT trade_date FROM seed)),
d AS (SELECT * FROM seed UNION ALL SELECT * FROM added)""") + """
SELECT date_id, trade_date, CAST(year(trade_date) AS INTEGER) AS year, CAST(quarter(trade_date) AS INTEGER) AS quarter,
       CAST(month(trade_date) AS INTEGER) AS month, CAST(day(trade_date) AS INTEGER) AS day FROM d"""

FACT_DAILY = """
SELECT row_number() OVER (ORDER BY d.date_id, s.symbol_id) AS fact_id, s.symbol_id, d.date_id,
       st.open_price, st.high_price, st.low_price, st.close_price, st.adj_close, st.volume
FROM staged st JOIN dim_symbol s ON s.symbol = st.symbol JOIN dim_date d ON d.trade_date = st.trade_date"""

SQL["fact_price_daily"] = w(STAGED, DIMS) + FACT_DAILY
SQL["fact_price_daily_incremental"] = w(STAGED, DIMS) + FACT_DAILY

SQL["fact_price_monthly"] = w(STAGED, DIMS) + """
SELECT s.symbol_id, CAST(year(st.trade_date) AS INTEGER) AS year, CAST(month(st.trade_date) AS INTEGER) AS month,
       round(avg(st.open_price), 6) AS avg_open,
       round(avg(st.close_price), 6) AS avg_close,
       round(avg(st.high_price), 6) AS avg_high,
       round(avg(st.low_price), 6) AS avg_low,
       CAST(sum(st.volume) AS BIGINT) AS total_volume
FROM staged st JOIN dim_symbol s ON s.symbol = st.symbol
GROUP BY s.symbol_id, year(st.trade_date), month(st.trade_date)"""

SQL["price_upsert"] = w(STAGED, """seed AS (
  SELECT symbol, price_date, CAST(open_price AS DOUBLE) AS open_price, CAST(high_price AS DOUBLE) AS high_price,
         CAST(low_price AS DOUBLE) AS low_price, CAST(close_price AS DOUBLE) AS close_price,
         CAST(adj_close AS DOUBLE) AS adj_close, volume
  FROM prices WHERE price_date <= DATE '1998-06-30')""") + """
SELECT symbol, trade_date AS price_date, open_price, high_price, low_price, close_price, adj_close, volume FROM staged
UNION ALL
SELECT * FROM seed s WHERE NOT EXISTS (SELECT 1 FROM staged t WHERE t.symbol = s.symbol AND t.trade_date = s.price_date)"""

SQL["bars_upsert"] = w(TICKS, """tgt AS (""" + BARS.format(unit="minute", extra="").replace(
    "FROM ticks", "FROM ticks WHERE ts < TIMESTAMP '2024-01-16 00:00:30'") + """),
src AS (""" + BARS.format(unit="minute", extra="").replace(
    "FROM ticks", "FROM ticks WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'") + ")") + """
SELECT * FROM src
UNION ALL SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.symbol = t.symbol AND s.minute_ts = t.minute_ts)"""

ORDER_PAYLOAD = """'{"order_id":' || order_id || ',"customer_id":' || customer_id || ',"symbol":"' || symbol
  || '","side":"' || side || '","qty":' || quantity || ',"price":' || CAST(price AS VARCHAR) || '}'"""
TRADE_PAYLOAD = """'{"trade_id":' || trade_id || ',"symbol":"' || symbol || '","qty":' || quantity
  || ',"price":' || CAST(trade_price AS VARCHAR) || '}'"""

REQUESTS = BOOK + """,
requests AS (
  SELECT order_id AS request_seq, customer_id, symbol,
         CASE WHEN order_id % 97 = 0 THEN 'HOLD' ELSE side END AS side,
         CASE WHEN order_id % 89 = 0 THEN CAST(0 AS BIGINT) ELSE quantity END AS quantity,
         price, created_at AS submitted_at
  FROM book),
checked AS (
  SELECT *, concat_ws(',',
           CASE WHEN customer_id IS NULL THEN 'customer_id' END,
           CASE WHEN symbol IS NULL OR length(symbol) = 0 THEN 'symbol' END,
           CASE WHEN side IS NULL OR side NOT IN ('BUY', 'SELL') THEN 'side' END,
           CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity' END,
           CASE WHEN price IS NULL OR price <= 0 THEN 'price' END) AS reason
  FROM requests)"""

SQL["order_intake"] = w(REQUESTS) + """
SELECT (SELECT coalesce(max(order_id), 0) FROM book WHERE status = 'FILLED')
         + row_number() OVER (ORDER BY request_seq) AS order_id,
       customer_id, symbol, side, quantity, CAST(0 AS BIGINT) AS filled_quantity, price,
       'PENDING' AS status, submitted_at AS created_at
FROM checked WHERE reason = ''"""

SQL["order_rejects"] = w(REQUESTS) + """
SELECT request_seq, customer_id, symbol, side, quantity, price, reason FROM checked WHERE reason <> ''"""

SQL["order_event_json"] = w(BOOK) + f"""
SELECT order_id, 'ORDER_CREATED' AS event_type, {ORDER_PAYLOAD} AS payload FROM book"""

SQL["trade_event_json"] = w(TRADES) + f"""
SELECT trade_id, 'TRADE_EXECUTED' AS event_type, {TRADE_PAYLOAD} AS payload FROM trades"""

OUTBOX = TRADES + """,
book AS (
  SELECT n AS order_id, o_custkey AS customer_id, p_brand AS symbol,
         CASE l_linestatus WHEN 'F' THEN 'BUY' ELSE 'SELL' END AS side,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         l_shipdate AS created_at
  FROM lines),
outbox AS (
  SELECT 2 * order_id - 1 AS event_id, 'ORDER_CREATED' AS event_type, """ + ORDER_PAYLOAD + """ AS payload,
         created_at AS created_ts FROM book
  UNION ALL
  SELECT 2 * trade_id, 'TRADE_EXECUTED', """ + TRADE_PAYLOAD + """, trade_time FROM trades),
pending AS (SELECT * FROM outbox WHERE event_id % 3 <> 0)"""

SQL["outbox_pending"] = w(OUTBOX) + """
SELECT event_id, event_type, payload, created_ts FROM pending ORDER BY created_ts, event_id LIMIT 100"""

SQL["outbox_routed"] = w(OUTBOX) + """
SELECT event_id, CASE WHEN upper(event_type) LIKE 'ORDER%' THEN 'order_events' ELSE 'trade_events' END AS topic,
       json_extract_string(payload, '$.symbol') AS key, payload AS value
FROM pending"""

SQL["stream_bars_1m"] = w(TICKS, "bars AS (" + BARS.format(unit="minute", extra="") + ")") + """
SELECT * FROM bars WHERE minute_ts + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM ticks)"""

SQL["stream_dedup"] = "SELECT event_id, ts, event_type, value FROM events"

SQL["stream_risk"] = SQL["risk_rolling"]

SQL["stream_bars_late"] = SQL["bars_1m"]


SQL["stream_match"] = w(BOOK, MATCH) + """
SELECT buy_order_id, sell_order_id, buyer_id, seller_id, symbol, quantity, trade_price FROM matched"""

SQL["holdings_from_snapshot"] = SQL["holdings"]

SQL["holdings_after_match"] = ("WITH RECURSIVE " + BOOK + ",\n" + MATCH + """,
trades AS (SELECT trade_id, buyer_id, seller_id, symbol, quantity, trade_price FROM matched),
""" + HOLDINGS + "\nSELECT * FROM holdings")

SQL["risk_upsert"] = SQL["risk_daily"]

SQL["top_traded_top5"] = SQL["top_traded"] + "\nLIMIT 5"

_PENDING = OUTBOX + """,
waiting AS MATERIALIZED (SELECT event_id, event_type, created_ts FROM pending),
sent AS MATERIALIZED (SELECT event_id FROM waiting ORDER BY created_ts, event_id LIMIT {n})"""

SQL["outbox_after_publish"] = w(_PENDING.replace("{n}", "100")) + """
SELECT event_id, event_type FROM waiting
WHERE NOT EXISTS (SELECT 1 FROM sent WHERE sent.event_id = waiting.event_id)"""

SQL["outbox_polls"] = w(_PENDING.replace("{n}", "400")) + """
SELECT event_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM sent WHERE sent.event_id = waiting.event_id) THEN 1 ELSE 0 END AS BIGINT) AS times_sent
FROM waiting"""

SQL["outbox_rejects"] = w(OUTBOX) + """
SELECT event_id, substr(payload, 1, instr(payload, '"side"') - 1) AS payload, 'payload' AS reason
FROM pending WHERE event_type = 'ORDER_CREATED' AND payload LIKE '%"side":"SELL"%'"""

SQL["holdings_short"] = ("WITH RECURSIVE " + TRADES.replace("trades AS (", "trades0 AS (") + """,
trades AS (
  SELECT trade_id, length(CAST(buyer_id AS VARCHAR)) + 3 * (buyer_id % 3) AS buyer_id,
         length(CAST(seller_id AS VARCHAR)) + 3 * (seller_id % 3) AS seller_id, symbol, quantity, trade_price
  FROM trades0),
""" + HOLDINGS + "\nSELECT * FROM holdings")

# positions and known closes, each at its own time; no shared definition with the operator
_GAPS = PRICES + """,
known AS (SELECT symbol, price_date, close_price FROM prices WHERE isodow(price_date) <> 5),
moves AS (
  SELECT buyer_id AS customer_id, symbol, CAST(trade_time AS DATE) AS d, quantity AS dq, -quantity * trade_price AS cash FROM trades
  UNION ALL
  SELECT seller_id, symbol, CAST(trade_time AS DATE), -quantity, quantity * trade_price FROM trades)"""

SQL["breach_daily_loss_gaps"] = w(_GAPS) + """,
days AS (SELECT customer_id, symbol, d, sum(cash) AS cash,
                sum(sum(dq)) OVER (PARTITION BY customer_id, symbol ORDER BY d) AS pos
         FROM moves GROUP BY customer_id, symbol, d),
val AS (SELECT days.*, coalesce(pos * close_price, 0) AS mtm
        FROM days ASOF LEFT JOIN known ON known.symbol = days.symbol AND days.d >= known.price_date),
pnl AS (SELECT customer_id, d, mtm - coalesce(lag(mtm) OVER (PARTITION BY customer_id, symbol ORDER BY d), 0) + cash AS p FROM val)
SELECT customer_id, d AS trade_date, CAST(sum(p) AS DECIMAL(38,2)) AS daily_pnl FROM pnl
GROUP BY customer_id, d HAVING sum(p) < -50000"""

SQL["daily_loss_day"] = w(_GAPS) + """,
ref AS (SELECT max(CAST(trade_time AS DATE)) AS d FROM trades),
pos AS (SELECT customer_id, symbol, sum(dq) AS after, sum(CASE WHEN d < (SELECT d FROM ref) THEN dq ELSE 0 END) AS before,
               sum(CASE WHEN d = (SELECT d FROM ref) THEN cash ELSE 0 END) AS cash
        FROM moves GROUP BY customer_id, symbol),
px AS (SELECT symbol, arg_max(close_price, price_date) AS now,
              arg_max(close_price, price_date) FILTER (WHERE price_date < (SELECT d FROM ref)) AS prev
       FROM known GROUP BY symbol)
SELECT customer_id, CAST(sum(coalesce(after * now, 0) - coalesce(before * prev, 0) + cash) AS DECIMAL(38,2)) AS daily_pnl
FROM pos LEFT JOIN px USING (symbol) GROUP BY customer_id"""

SQL["ticks_parsed"] = w(TICKS) + """
SELECT seq, symbol, date_trunc('second', ts) AS ts, price, size FROM ticks WHERE size NOT IN (0, 1) OR size IS NULL"""
SQL["tick_rejects"] = w(TICKS) + "SELECT seq FROM ticks WHERE size IN (0, 1)"

SQL["stream_rejects"] = SQL["tick_rejects"]

SQL["stream_ticks_kept"] = SQL["ticks_parsed"]

SQL["stream_bars_upsert"] = SQL["stream_bars_1m"]
SQL["stream_risk_upsert"] = SQL["risk_daily"]

SQL["stage_duplicates"] = w(STAGED) + """
SELECT * REPLACE (CASE WHEN dayofyear(trade_date) % 31 = 11 THEN 0 ELSE volume + 1 END AS volume) FROM staged"""


def _match(orders: str, tag: str) -> str:
    """The match of a table of orders, every name with a tag."""
    sql = MATCH.replace("FROM book", "FROM " + orders).replace("('PENDING', 'OPEN')", "('PENDING', 'OPEN', 'PARTIAL')")
    for name in ("open_orders", "matched", "mb", "ms", "mx"):
        sql = re.sub(rf"\b{name}\b", name + tag, sql)
    return sql


def _run(half: str, before: str, last_order: str, last_trade: str, last_event: str, tag: str) -> str:
    """One run of intake and matching: the orders placed, matched and afterwards, and their events."""
    payload_o, payload_t = ORDER_PAYLOAD, TRADE_PAYLOAD
    return f"""placed{tag} AS (
  SELECT ({last_order}) + row_number() OVER (ORDER BY request_seq) AS order_id, customer_id, symbol, side, quantity,
         CAST(0 AS BIGINT) AS filled_quantity, price, 'PENDING' AS status, submitted_at AS created_at
  FROM checked WHERE reason = '' AND request_seq {half} (SELECT max(request_seq) // 2 FROM checked)),
orders{tag} AS (SELECT * FROM placed{tag} {before}),
{_match(f"orders{tag}", tag)},
traded{tag} AS (SELECT * REPLACE (trade_id + ({last_trade}) AS trade_id) FROM matched{tag}),
fills{tag} AS (SELECT order_id, sum(quantity) AS q FROM (
    SELECT buy_order_id AS order_id, quantity FROM traded{tag} UNION ALL SELECT sell_order_id, quantity FROM traded{tag})
  GROUP BY order_id),
after{tag} AS (SELECT o.* REPLACE (o.filled_quantity + coalesce(q, 0) AS filled_quantity,
    CASE WHEN q IS NULL THEN status WHEN o.filled_quantity + q >= o.quantity THEN 'FILLED' ELSE 'PARTIAL' END AS status)
  FROM orders{tag} o LEFT JOIN fills{tag} USING (order_id)),
new_o{tag} AS (SELECT created_at, symbol, {payload_o} AS payload FROM placed{tag}),
ev_o{tag} AS (SELECT ({last_event}) + row_number() OVER (ORDER BY created_at, payload) AS event_id,
                     'order_events' AS topic, symbol AS key, payload AS value FROM new_o{tag}),
new_t{tag} AS (SELECT symbol, {payload_t} AS payload FROM traded{tag}),
ev_t{tag} AS (SELECT (SELECT max(event_id) FROM ev_o{tag}) + row_number() OVER (ORDER BY payload) AS event_id,
                     'trade_events' AS topic, symbol AS key, payload AS value FROM new_t{tag})"""


SQL["order_flow_two_runs"] = w(
    REQUESTS,
    _run("<=", "", "0", "0", "0", "_1"),
    _run(">", "UNION ALL SELECT * FROM after_1", "SELECT max(order_id) FROM placed_1", "SELECT max(trade_id) FROM traded_1",
         "SELECT max(event_id) FROM ev_t_1", "_2")) + """
SELECT * FROM ev_o_1 UNION ALL SELECT * FROM ev_t_1 UNION ALL SELECT * FROM ev_o_2 UNION ALL SELECT * FROM ev_t_2"""

SQL["price_upsert_bucketed"] = SQL["price_upsert"]

SQL["stream_outbox_source"] = SQL["outbox_routed"]

SQL["sql_customer_pnl"] = SQL["customer_pnl"]

SQL["sql_top_traded"] = SQL["top_traded_day"]

SQL["sql_price_history"] = w(PRICES, "last AS (SELECT max(CAST(trade_time AS DATE)) AS d, min(symbol) AS s FROM trades)") + """
SELECT symbol, price_date, open_price, high_price, low_price, close_price, volume FROM prices, last
WHERE symbol = s AND price_date > d - INTERVAL 12 MONTH AND price_date <= d"""

SQL["sql_settlement"] = w(TRADES, "days AS (SELECT DISTINCT CAST(trade_time AS DATE) AS d FROM trades ORDER BY d DESC LIMIT 2)") + """
SELECT CAST(1 + (SELECT count(*) FROM days b WHERE b.d < days.d) AS BIGINT) AS settlement_id, d AS trade_date, symbol,
       CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(quantity * trade_price) AS DECIMAL(38,2)) AS total_value, 'COMPLETED' AS status
FROM trades JOIN days ON CAST(trade_time AS DATE) = d GROUP BY d, symbol"""
