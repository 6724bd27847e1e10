"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query to completion on ``local[$BENCH_CPUS]`` (results
are consumed by the no-op sink, nothing is collected) and prints one JSON
line.  The fixture tables (numbered trades / book, staged price files) are
built once first and reported separately as ``fixtures``; ``value`` is the
sum over the headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickbook.plans.registry import QUERIES  # noqa: E402
from tickbook.session import build_session  # noqa: E402
from tickbook.sources import fixtures as fx  # noqa: E402

HEADLINE = ["match_price_time", "orders_after_match", "match_best_buy", "holdings", "unrealized_pnl",
            "settle_all", "top_traded", "ledger_daily", "bars_1m", "risk_rolling", "risk_daily",
            "fact_price_daily", "fact_price_monthly", "stage_prices", "outbox_routed", "order_intake",
            "stream_bars_1m", "stream_risk", "stream_match"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="tickbook-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    t0 = time.time()
    fx.lines(spark, sf_dir)
    fx.staged_prices(spark, sf_dir)
    fixtures = time.time() - t0
    times = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    from tickbook.operators.matching import open_book
    n_open = open_book(fx.book(spark, sf_dir)).count()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "fixtures": round(fixtures, 3), "sf": sf, "cpus": cpus,
                      "open_orders_matched": n_open,
                      "match_orders_per_sec": round(n_open / times["match_price_time"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
