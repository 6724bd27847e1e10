"""The unified data model (one schema for the operational tables and the star).

Column names follow the operational variant of the reference; prices are
``decimal(18,2)`` where they come from orders and trades, ``double`` where they
come from vendor files and analytics, quantities ``bigint``, times zone-less
timestamps (session time zone UTC).  Tables without logic in the reference
(stg_minute_bar, stg_corp_actions, dim_security, dim_customers) are listed
for completeness only.
"""

from __future__ import annotations

from pyspark.sql import types as T

P = "decimal(18,2)"

DDL: dict[str, str] = {
    # staging
    "stg_historical_price": ("symbol string, trade_date date, open_price double, high_price double, "
                             "low_price double, close_price double, adj_close double, volume bigint, "
                             "load_ts timestamp"),
    "stg_minute_bar": ("symbol string, minute_ts timestamp_ntz, open_price double, high_price double, "
                       "low_price double, close_price double, volume bigint, load_ts timestamp"),
    "stg_corp_actions": "symbol string, action_date date, action_type string, details string, load_ts timestamp",
    # operational
    "dim_customers": f"customer_id bigint, customer_name string, cash_balance {P}",
    "dim_security": "symbol string, company_name string, sector string, industry string",
    "orders": (f"order_id bigint, customer_id bigint, symbol string, side string, quantity bigint, "
               f"filled_quantity bigint, price {P}, status string, created_at timestamp_ntz"),
    "trades": (f"trade_id bigint, buy_order_id bigint, sell_order_id bigint, buyer_id bigint, seller_id bigint, "
               f"symbol string, quantity bigint, trade_price {P}, trade_time timestamp_ntz"),
    "holdings": "customer_id bigint, symbol string, quantity bigint, average_cost double",
    "outbox_events": "event_id bigint, event_type string, payload string, created_ts timestamp_ntz, dispatched string",
    "audit_errors": "err_id bigint, component string, err_ts timestamp, message string",
    # warehouse
    "dim_symbol": "symbol_id bigint, symbol string, company_name string",
    "dim_date": "date_id bigint, trade_date date, year int, quarter int, month int, day int",
    "fact_price": ("symbol string, price_date date, open_price double, high_price double, low_price double, "
                   "close_price double, adj_close double, volume bigint"),
    "fact_price_daily": ("fact_id bigint, symbol_id bigint, date_id bigint, open_price double, high_price double, "
                         "low_price double, close_price double, adj_close double, volume bigint"),
    "fact_price_monthly": ("symbol_id bigint, year int, month int, avg_open double, avg_close double, "
                           "avg_high double, avg_low double, total_volume bigint"),
    "fact_tick_agg": ("symbol string, minute_ts timestamp_ntz, open_price double, high_price double, "
                      "low_price double, close_price double, volume bigint, tick_count bigint"),
    "fact_trade_agg": "symbol string, trade_date date, total_qty bigint, total_value decimal(38,2)",
    "fact_symbol_risk": "symbol string, risk_ts timestamp_ntz, risk_score double, model_version string",
    "fact_settlement": "settlement_id bigint, settlement_date date, status string",
}


def schema(table: str) -> T.StructType:
    return T._parse_datatype_string(DDL[table])
