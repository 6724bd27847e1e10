"""Command line for the batch jobs, for a scheduler (``spark-submit`` or
``python -m tickbook``):

    python -m tickbook load-prices  --csv-dir DIR --fact-price PATH [--load-date YYYY-MM-DD] [--audit PATH]
    python -m tickbook settle-day   --trades PATH --fact-trade-agg PATH --day YYYY-MM-DD [--log PATH] [--audit PATH]
    python -m tickbook match-book   --orders PATH [--holdings PATH] [--audit PATH]
    python -m tickbook place-orders --requests PATH [--orders PATH] [--audit PATH]

Inputs and outputs are Parquet folders (CSV for price files).  The session
comes from the submitting environment (``getOrCreate``); with ``--audit`` a
failure appends an audit_errors row before the job exits with an error.
"""

from __future__ import annotations

import argparse
import contextlib
import json
import sys

from pyspark.sql import SparkSession

from .plans import jobs
from .session import apply_runtime_conf


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tickbook")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("load-prices")
    p.add_argument("--csv-dir", required=True)
    p.add_argument("--fact-price", required=True)
    p.add_argument("--load-date")
    p = sub.add_parser("settle-day")
    p.add_argument("--trades", required=True)
    p.add_argument("--fact-trade-agg", required=True)
    p.add_argument("--day", required=True)
    p.add_argument("--log")
    p = sub.add_parser("match-book")
    p.add_argument("--orders", required=True)
    p.add_argument("--holdings")
    p = sub.add_parser("place-orders")
    p.add_argument("--requests", required=True)
    p.add_argument("--orders")
    for p in sub.choices.values():
        p.add_argument("--audit", help="audit_errors table (Parquet folder)")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tickbook-{a.job}").getOrCreate()
    apply_runtime_conf(spark)
    guard = jobs.audited(spark, a.audit, a.job) if a.audit else contextlib.nullcontext()
    with guard:
        if a.job == "load-prices":
            out = jobs.load_prices(spark, a.csv_dir, a.fact_price, a.load_date)
        elif a.job == "settle-day":
            jobs.settle_day(spark, spark.read.parquet(a.trades), a.fact_trade_agg, a.day, a.log)
            out = {"fact_trade_agg": a.fact_trade_agg}
        elif a.job == "match-book":
            prev = spark.read.parquet(a.holdings) if a.holdings else None
            out = jobs.match_book(spark, spark.read.parquet(a.orders), prev)
        else:
            orders = spark.read.parquet(a.orders) if a.orders else None
            out = jobs.place_orders(spark, spark.read.parquet(a.requests), orders)
    print(json.dumps({"job": a.job, "outputs": out}))
    return out


if __name__ == "__main__":
    sys.exit(0 if main() is not None else 1)
