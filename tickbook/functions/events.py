"""Event payloads (JSON text) and their parsing.

The reference builds JSON by string concatenation (no escaping, invalid for
NULL prices); here ``to_json(struct(...))`` does it, field names and order as
in the reference's messages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_CREATED = "ORDER_CREATED"
TRADE_EXECUTED = "TRADE_EXECUTED"

TICK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.LongType()),
])

ORDER_EVENT_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("qty", T.LongType()),
    T.StructField("price", T.DecimalType(18, 2)),
])


def order_created_payload() -> Column:
    """{"order_id", "customer_id", "symbol", "side", "qty", "price"} of an order row."""
    return F.to_json(F.struct("order_id", "customer_id", "symbol", "side",
                              F.col("quantity").alias("qty"), "price"))


def trade_executed_payload() -> Column:
    """{"trade_id", "symbol", "qty", "price"} of a trade row."""
    return F.to_json(F.struct("trade_id", "symbol", F.col("quantity").alias("qty"),
                              F.col("trade_price").alias("price")))


def parse(value: Column, schema: T.StructType) -> Column:
    """Permissive JSON parse: a malformed message gives a NULL struct."""
    return F.from_json(value, schema, {"mode": "PERMISSIVE"})
