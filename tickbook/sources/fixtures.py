"""Adapters from the driver's TPC-H-like tables to the trading data model.

The mapping (which column plays which role) is fixed by FIXTURES.md §C so that
an independent SQL engine can build the very same inputs:

* ``lines``   lineitem ⋈ orders ⋈ part, numbered ``n`` in (ship date, all
  lineitem columns) order - the one numbering shared by trades and the book;
* ``trades``  trade_id = n, buyer = o_custkey, seller = l_suppkey,
  symbol = p_brand, quantity = l_quantity, trade_price = l_extendedprice;
* ``book``    order_id = n, side from l_linestatus, status from l_returnflag;
* ``ticks``   symbol = event_type, price = value, size = props.k, seq = event_id;
* ``prices``  daily open/high/low/close/volume per symbol from the trades.

The numbered ``lines`` table is written once per session and state of the files to the
shared scratch folder; every adapter then reads it as a plain Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import with_global_index
from ..session import modified, range_partitions, scratch_kept, scratch_path
from .tables import read_table, table_path

PRICE = "decimal(18,2)"

# Order of the fixture numbering (FIXTURES.md §C): all lineitem columns.
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
# What the adapters read of a numbered line.
LINE_COLS = ["o_custkey", "l_suppkey", "p_brand", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
             "l_shipdate"]
LINES_PER_PARTITION = 1_000_000      # a sort holds about 225 bytes a line, and four tasks share an executor
LINES_PER_PASS = 8_000_000           # below it the shuffles of the joins are too small to matter on disk
MAX_PASSES = 2                       # with two, the joins need less disk than the numbering; a pass reads the lines again

_materialised: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, label: str) -> tuple:
    """Files changed under the same path are other tables."""
    times = tuple(modified(spark, table_path(sf_dir, t)) for t in ("lineitem", "orders", "part"))
    return spark.sparkContext.applicationId, sf_dir, times, label


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _key(spark, sf_dir, "lines")
    path = _materialised.get(key)
    if path is None:
        li = read_table(spark, sf_dir, "lineitem", LINE_ORDER)
        od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
        pt = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
        # hash joins with the narrow tables as the hashed sides: the wide lines pass through
        # unsorted, and no growing table is broadcast.  The partitions are sized by the line count
        # (a line joins at most one order and one part): AQE sizes them by compressed bytes, and
        # lines compress well.
        rows = li.count()
        n = max(range_partitions(spark, rows), -(-rows // LINES_PER_PARTITION))
        joined = (li.repartition(n, "l_orderkey").join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey)
                    .repartition(n, "l_partkey").join(pt.hint("shuffle_hash"), li.l_partkey == pt.p_partkey)
                    .drop("o_orderkey", "p_partkey"))
        # a block around this call frees the numbering's table; the lines stay
        numbered = with_global_index(joined, LINE_ORDER, "n", num_partitions=n, keep=LINE_COLS, staged="l_orderkey",
                                     passes=min(MAX_PASSES, -(-rows // LINES_PER_PASS) or 1))
        with scratch_kept():
            path = scratch_path(spark, "fixture-lines")
        # a double becomes a decimal by way of its text: once here, not at every read
        price = F.col("l_extendedprice").cast(PRICE).alias("l_extendedprice")
        numbered.select("n", *[price if c == "l_extendedprice" else c for c in LINE_COLS]).write.mode("overwrite").parquet(path)
        _materialised[key] = path
    return spark.read.parquet(path)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select(
        F.col("n").alias("trade_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("p_brand").alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("trade_price"),
        F.col("l_shipdate").alias("trade_time"),
    )


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    qty = F.col("l_quantity").cast("bigint")
    return lines(spark, sf_dir).select(
        F.col("n").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_brand").alias("symbol"),
        F.when(F.col("l_linestatus") == "F", "BUY").otherwise("SELL").alias("side"),
        qty.alias("quantity"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0).cast("bigint")).alias("filled_quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.when(F.col("l_returnflag") == "N", "PENDING")
         .when(F.col("l_returnflag") == "A", "OPEN")
         .otherwise("FILLED").alias("status"),
        F.col("l_shipdate").alias("created_at"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value", "props"])
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("symbol"),
        F.col("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the fixture trades: the stand-in for the vendor price files."""
    t = trades(spark, sf_dir)
    return (t.groupBy("symbol", F.to_date("trade_time").alias("price_date"))
             .agg(F.min_by("trade_price", "trade_id").alias("open_price"),
                  F.max("trade_price").alias("high_price"),
                  F.min("trade_price").alias("low_price"),
                  F.max_by("trade_price", "trade_id").alias("close_price"),
                  F.max_by("trade_price", "trade_id").alias("adj_close"),
                  F.sum("quantity").cast("bigint").alias("volume")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_customers: cash_balance is the account balance of the TPC-H customer."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    return c.select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("c_acctbal").cast(PRICE).alias("cash_balance"))


# Fixed values of the CSV fixture's damage rule (FIXTURES.md §D "CSV cleanse"):
# day of year modulo 31 selects rows whose open is 'abc', whose volume is
# empty, or whose close is empty.
DOY_MOD, BAD_OPEN, EMPTY_VOLUME, EMPTY_CLOSE = 31, 7, 11, 19


def _memo(spark: SparkSession, sf_dir: str, label: str, build) -> str:
    key = _key(spark, sf_dir, label)
    path = _materialised.get(key)
    if path is None:
        with scratch_kept():
            path = build()
        _materialised[key] = path
    return path


def price_csv_dir(spark: SparkSession, sf_dir: str) -> str:
    """The vendor price files: ``prices`` exported as per-symbol CSVs, with
    some damaged cells by the rule above."""
    from .price_files import export_price_files

    def build():
        p = prices(spark, sf_dir)
        doy = F.dayofyear("price_date") % DOY_MOD
        rows = p.select(
            F.date_format("price_date", "yyyy-MM-dd").alias("date"),
            F.col("symbol").alias("Symbol"),
            F.when(doy == BAD_OPEN, F.lit("abc")).otherwise(F.col("open_price").cast("string")).alias("open"),
            F.col("high_price").cast("string").alias("high"),
            F.col("low_price").cast("string").alias("low"),
            F.when(doy == EMPTY_CLOSE, F.lit(None).cast("string"))
             .otherwise(F.col("close_price").cast("string")).alias("close"),
            F.col("adj_close").cast("string").alias("adj_close"),
            F.when(doy == EMPTY_VOLUME, F.lit(None).cast("string"))
             .otherwise(F.col("volume").cast("string")).alias("volume"))
        out = scratch_path(spark, "price-csv")
        export_price_files(rows, out)
        return out
    return _memo(spark, sf_dir, "price-csv", build)


def _staging_paths(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    from ..operators.staging import load_price_files

    def build():
        staged, rejects = load_price_files(spark, price_csv_dir(spark, sf_dir), load_ts="2000-01-01 00:00:00")
        return staged + "|" + rejects
    return tuple(_memo(spark, sf_dir, "staging", build).split("|"))


def staged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stg_historical_price after the CSV load of ``price_csv_dir``."""
    return spark.read.parquet(_staging_paths(spark, sf_dir)[0])


def staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_staging_paths(spark, sf_dir)[1])


# Fixed values of FIXTURES.md §C: requests whose number is a multiple of 97
# carry side 'HOLD', multiples of 89 quantity 0; an outbox event counts as
# dispatched when its id is a multiple of 3.
BAD_SIDE_EVERY, ZERO_QTY_EVERY, DISPATCHED_EVERY = 97, 89, 3


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order requests (customer, symbol, side, quantity, price) in submission order."""
    b = book(spark, sf_dir)
    n = F.col("order_id")
    return b.select(n.alias("request_seq"), "customer_id", "symbol",
                    F.when(n % BAD_SIDE_EVERY == 0, F.lit("HOLD")).otherwise(F.col("side")).alias("side"),
                    F.when(n % ZERO_QTY_EVERY == 0, F.lit(0).cast("bigint")).otherwise(F.col("quantity")).alias("quantity"),
                    "price", F.col("created_at").alias("submitted_at"))


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """outbox_events: ORDER_CREATED per book order (id 2n-1), TRADE_EXECUTED per trade (id 2n)."""
    from ..operators.intake import order_events
    from ..operators.outbox import trade_events
    o = order_events(book(spark, sf_dir)).select(
        (F.col("order_id") * 2 - 1).alias("event_id"), "event_type", "payload", "created_ts")
    t = trade_events(trades(spark, sf_dir)).select(
        (F.col("trade_id") * 2).alias("event_id"), "event_type", "payload", "created_ts")
    ev = o.unionByName(t)
    return ev.withColumn("dispatched", F.when(F.col("event_id") % DISPATCHED_EVERY == 0, "Y").otherwise("N"))
