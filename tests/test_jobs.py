import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tickbook.plans import jobs
from tickbook.sources import fixtures as fx

from .conftest import SF001


def test_load_prices_twice_is_idempotent(spark):
    csv_dir = fx.price_csv_dir(spark, SF001)
    fact = os.path.join(tempfile.mkdtemp(prefix="tb-job-"), "fact_price")
    jobs.load_prices(spark, csv_dir, fact)
    first = sorted(map(tuple, spark.read.parquet(fact).collect()))
    jobs.load_prices(spark, csv_dir, fact)
    assert sorted(map(tuple, spark.read.parquet(fact).collect())) == first
    assert len(first) == fx.staged_prices(spark, SF001).count()


def test_settle_day_rewrites_one_partition(spark):
    t = fx.trades(spark, SF001)
    days = [r[0] for r in t.select(F.to_date("trade_time")).distinct().orderBy(1).limit(2).collect()]
    path = os.path.join(tempfile.mkdtemp(prefix="tb-job-"), "fact_trade_agg")
    for d in days + days:
        jobs.settle_day(spark, t, path, d)
    got = spark.read.parquet(path)
    assert sorted(r[0] for r in got.select("trade_date").distinct().collect()) == days
    want = t.filter(F.to_date("trade_time").isin(days)).agg(F.sum("quantity")).first()[0]
    assert got.agg(F.sum("total_qty")).first()[0] == want


def test_match_book_outputs_consistent(spark):
    paths = jobs.match_book(spark, fx.book(spark, SF001))
    trades = spark.read.parquet(paths["trades"])
    orders = spark.read.parquet(paths["orders"])
    traded = trades.agg(F.sum("quantity")).first()[0]
    filled = orders.agg(F.sum("filled_quantity")).first()[0]
    base = fx.book(spark, SF001).agg(F.sum("filled_quantity")).first()[0]
    assert filled - base == 2 * traded
    assert spark.read.parquet(paths["events"]).count() == trades.count()
    h = spark.read.parquet(paths["holdings"])
    assert h.count() > 0 and set(h.columns) == {"customer_id", "symbol", "quantity", "average_cost"}


def test_place_orders_ids_follow_existing(spark):
    req = fx.order_requests(spark, SF001)
    existing = fx.book(spark, SF001).filter(F.col("created_at") < F.lit(dt.datetime(1999, 1, 1)))
    paths = jobs.place_orders(spark, req, existing)
    new = spark.read.parquet(paths["orders"])
    lo, hi, n = new.agg(F.min("order_id"), F.max("order_id"), F.count(F.lit(1))).first()
    assert lo == existing.agg(F.max("order_id")).first()[0] + 1 and hi - lo + 1 == n
    assert n + spark.read.parquet(paths["rejects"]).count() == req.count()


def test_load_star_runs_on_staging(spark):
    staged = fx.staged_prices(spark, SF001)
    paths = jobs.load_star(spark, staged)
    ds = spark.read.parquet(paths["dim_symbol"])
    fd = spark.read.parquet(paths["fact_price_daily"])
    assert ds.count() == staged.select("symbol").distinct().count()
    assert fd.count() == staged.count()
    assert fd.agg(F.countDistinct("fact_id")).first()[0] == fd.count()


def test_outbox_stream_publishes_pending_once(spark):
    from tickbook.streaming.outbox import publish_stream
    ob = fx.outbox(spark, SF001)
    src = os.path.join(tempfile.mkdtemp(prefix="tb-outbox-"), "events")
    ob.write.parquet(src)
    base = tempfile.mkdtemp(prefix="tb-pub-")
    stream = spark.readStream.schema(ob.schema).parquet(src)
    for _ in range(2):   # the second run has nothing new: no duplicates
        publish_stream(stream, base + "/sink", base + "/ledger", base + "/ck").awaitTermination()
    sink = spark.read.parquet(base + "/sink")
    n_pending = ob.filter(F.col("dispatched") == "N").count()
    assert sink.count() == n_pending
    from tickbook.operators import dispatch, outbox
    runs = dispatch.read(spark, base + "/ledger")
    assert runs.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] == n_pending
    assert outbox.pending(ob, runs).isEmpty()
    assert sorted(r[0] for r in sink.select("topic").distinct().collect()) == ["order_events", "trade_events"]


def test_failed_load_is_audited_and_leaves_fact_unchanged(spark):
    import pytest
    base = tempfile.mkdtemp(prefix="tb-audit-")
    good = os.path.join(base, "good")
    os.makedirs(good)
    with open(os.path.join(good, "A.csv"), "w") as f:
        f.write("date,Symbol,open,high,low,close,adj_close,volume\n2024-01-02,A,1,2,1,1.5,1.5,3\n")
    fact = os.path.join(base, "fact_price")
    jobs.load_prices(spark, good, fact)
    before = sorted(map(tuple, spark.read.parquet(fact).collect()))
    bad = os.path.join(base, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "B.csv"), "w") as f:
        f.write("date,Symbol,open,high,low,close,volume\n2024-01-03,B,1,2,1,1.5,3\n")
    audit = os.path.join(base, "audit_errors")
    with pytest.raises(ValueError):
        with jobs.audited(spark, audit, "load_prices"):
            jobs.load_prices(spark, bad, fact)
    rows = spark.read.parquet(audit).collect()
    assert set(rows[0].asDict()) == {"err_id", "component", "err_ts", "message"}
    assert len(rows) == 1 and rows[0].err_id > 0 and rows[0].component == "load_prices" and "adj_close" in rows[0].message
    assert sorted(map(tuple, spark.read.parquet(fact).collect())) == before


def test_settle_day_logs_completion(spark):
    t = fx.trades(spark, SF001)
    day = t.agg(F.max(F.to_date("trade_time"))).first()[0]
    base = tempfile.mkdtemp(prefix="tb-settle-")
    jobs.settle_day(spark, t, base + "/agg", day, settlement_log_path=base + "/log")
    jobs.settle_day(spark, t, base + "/agg", day, settlement_log_path=base + "/log")
    log = spark.read.parquet(base + "/log").collect()
    assert sorted((r.settlement_id, r.settlement_date, r.status) for r in log) == [(1, day, "COMPLETED"), (2, day, "COMPLETED")]


def test_cli_runs_jobs(spark):
    from tickbook.__main__ import main
    base = tempfile.mkdtemp(prefix="tb-cli-")
    trades = base + "/trades"
    fx.trades(spark, SF001).write.parquet(trades)
    day = spark.read.parquet(trades).agg(F.max(F.to_date("trade_time"))).first()[0]
    main(["settle-day", "--trades", trades, "--fact-trade-agg", base + "/agg", "--day", str(day),
          "--log", base + "/log"], spark=spark)
    assert spark.read.parquet(base + "/log").count() == 1
    orders = base + "/orders"
    fx.book(spark, SF001).write.parquet(orders)
    out = main(["match-book", "--orders", orders], spark=spark)
    assert spark.read.parquet(out["trades"]).count() > 0


def test_order_flow_composes_over_two_runs(spark):
    """intake -> match -> publish, twice: ids continue, a PARTIAL rest trades on, nothing is sent twice."""
    from tickbook.operators import dispatch, outbox
    from tickbook.plans import jobs
    from tickbook.session import scratch_path
    cols = "request_seq bigint, customer_id bigint, symbol string, side string, quantity bigint, price decimal(18,2), submitted_at timestamp_ntz"
    from datetime import datetime as D
    from decimal import Decimal as X
    one = spark.createDataFrame([(1, 1, "A", "BUY", 100, X("10.00"), D(2024, 1, 1)), (2, 2, "A", "SELL", 60, X("9.00"), D(2024, 1, 1, 1))], cols)
    two = spark.createDataFrame([(3, 3, "A", "SELL", 40, X("10.00"), D(2024, 1, 2))], cols)
    sink, ledger = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ledger")

    def read(paths, *names):
        return [spark.read.parquet(paths[n]) for n in names]
    orders, created = read(jobs.place_orders(spark, one, None), "orders", "events")
    orders, trades, executed = read(jobs.match_book(spark, orders, outbox=created), "orders", "trades", "events")
    box = created.unionByName(executed)
    outbox.publish(spark, outbox.next_batch(box), sink, ledger)
    new, created2 = read(jobs.place_orders(spark, two, orders, box), "orders", "events")
    box = box.unionByName(created2)
    book = orders.unionByName(new.select(*orders.columns), allowMissingColumns=True) if set(orders.columns) <= set(new.columns) \
        else orders.unionByName(new, allowMissingColumns=True)
    t2, executed2 = read(jobs.match_book(spark, book, trades_table=trades, outbox=box), "trades", "events")
    box = box.unionByName(executed2)
    assert [r.trade_id for r in trades.collect()] == [1] and [(r.trade_id, r.quantity, r.buy_order_id) for r in t2.collect()] == [(2, 40, 1)]
    ids = sorted(r.event_id for r in box.collect())
    assert ids == [1, 2, 3, 4, 5]
    assert {r.event_id for r in outbox.pending(box, dispatch.read(spark, ledger)).collect()} == {4, 5}
    outbox.publish(spark, outbox.next_batch(box, dispatch.read(spark, ledger)), sink, ledger)
    assert outbox.pending(box, dispatch.read(spark, ledger)).isEmpty()
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ids


def test_streaming_publisher_replay_writes_the_ledger(spark):
    from datetime import datetime as D

    from tickbook.operators import dispatch
    from tickbook.session import scratch_path
    from tickbook.streaming.outbox import publish_batches
    sink, ledger, rejects = (scratch_path(spark, x) for x in ("p-sink", "p-ledger", "p-rejects"))
    rows = spark.createDataFrame([(1, "ORDER_CREATED", '{"symbol":"A"}', D(2024, 1, 1), "N"), (2, "TRADE_EXECUTED", "not json", D(2024, 1, 1), "N")],
                                 "event_id bigint, event_type string, payload string, created_ts timestamp_ntz, dispatched string")
    publish_batches(sink, scratch_path(spark, "lost-ledger"), rejects)(rows, 0)      # the ledger write is lost
    publish_batches(sink, ledger, rejects)(rows, 0)
    assert [(r.lo, r.hi) for r in dispatch.read(spark, ledger).collect()] == [(1, 2)]
    assert [r.event_id for r in spark.read.parquet(sink).collect()] == [1]
    assert [r.event_id for r in spark.read.parquet(rejects).collect()] == [2]


def test_daily_loss_keeps_positions_over_price_gaps(spark):
    from datetime import date, datetime
    from decimal import Decimal as X

    from tickbook.operators import reports
    t = spark.createDataFrame([(1, 7, 8, "A", 100, X("50.00"), datetime(2024, 1, 1, 9)), (2, 7, 8, "A", 100, X("50.00"), datetime(2024, 1, 2, 9))],
                              "trade_id bigint, buyer_id bigint, seller_id bigint, symbol string, quantity bigint, trade_price decimal(18,2), trade_time timestamp_ntz")
    p = spark.createDataFrame([("A", date(2024, 1, 1), X("50.00")), ("A", date(2024, 1, 3), X("40.00"))],
                              "symbol string, price_date date, close_price decimal(18,2)")
    got = {r.customer_id: r.daily_pnl for r in reports.daily_loss_as_of(t, p, "2024-01-03").collect()}
    assert got == {7: X("-2000.00"), 8: X("2000.00")}
    days = {(r.customer_id, r.trade_date.day): r.daily_pnl for r in reports.daily_pnl(t, p).collect()}
    assert days == {(7, 1): 0, (8, 1): 0, (7, 2): 0, (8, 2): 0}


def test_write_upsert_rejects_two_rows_for_a_key(spark):
    import pytest

    from tickbook.operators.upsert import write_upsert
    from tickbook.session import scratch_path
    path = scratch_path(spark, "dup-target")
    s = "k int, v int, m string"
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], s).write.partitionBy("m").parquet(path)
    with pytest.raises(ValueError):
        write_upsert(spark, path, spark.createDataFrame([(1, 5, "a"), (1, 6, "a")], s), ["k"], "m")
    write_upsert(spark, path, spark.createDataFrame([(1, 5, "a"), (3, 6, "a")], s), ["k"], "m")
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, 5), (2, 2), (3, 6)}


def test_events_are_numbered_as_by_payload_without_storing_payloads(spark):
    """Times that repeat or are missing, ids of several lengths."""
    import glob

    from tickbook.operators import intake
    from tickbook.operators.outbox import outbox_rows, trade_events
    from tickbook.session import checkpoint_root
    from tickbook.sources.fixtures import PRICE
    cols = f"request_seq bigint, customer_id bigint, symbol string, side string, quantity bigint, price {PRICE}, submitted_at timestamp_ntz"
    times = [dt.datetime(2024, 1, 1), None, dt.datetime(2023, 1, 1)]
    asked = spark.createDataFrame([(i, i % 7, f"S{i % 2}", "BUY" if i % 3 else "SELL", 1 + i % 4, None if i == 5 else 10 + i % 2, times[i % 3])
                                   for i in range(1, 130)], "request_seq long, customer_id long, symbol string, side string, quantity long, price long, "
                                  "submitted_at timestamp_ntz").selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in cols.split(", ")])
    folder = checkpoint_root(spark).removeprefix("file:") + "/tickbook/index-event_id-*"
    before = set(glob.glob(folder))
    placed = jobs.place_orders(spark, asked, None)
    done = jobs.match_book(spark, spark.read.parquet(placed["orders"]), outbox=spark.read.parquet(placed["events"]))
    for path in set(glob.glob(folder)) - before:
        assert "payload" not in spark.read.parquet(path).columns
    orders, trades = spark.read.parquet(placed["orders"]), spark.read.parquet(done["trades"])
    box = spark.read.parquet(placed["events"])
    assert trades.count() > 10 and orders.count() == 128 and spark.read.parquet(placed["rejects"]).first().reason == "price"
    assert sorted(box.collect()) == sorted(outbox_rows(intake.order_events(orders)).collect())
    assert sorted(spark.read.parquet(done["events"]).collect()) == sorted(outbox_rows(trade_events(trades), box).collect())
