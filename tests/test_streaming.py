import datetime as dt
import os
import tempfile

import numpy as np
import pytest

from tickbook.streaming.bars import stream_bars
from tickbook.streaming.risk import emission_scores
from tickbook.streaming.sources import LateRows

TICK = "symbol string, ts timestamp, price double, seq long"


def _run_bars_per_file(spark, batches):
    """One trigger per file: add a file, run the query until caught up, repeat."""
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(TICK)
    src_dir = tempfile.mkdtemp(prefix="tb-ticks-")
    out = tempfile.mkdtemp(prefix="tb-bars-out-")
    late = LateRows()
    spark.streams.addListener(late)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TICK).coalesce(1).write.parquet(os.path.join(src_dir, f"b{i:02d}"))
        src = spark.readStream.schema(schema).option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.parquet").parquet(src_dir)
        q = (stream_bars(src).writeStream.format("parquet").option("path", out + "/data")
             .option("checkpointLocation", out + "/ck").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    dropped = late.dropped(q)
    spark.streams.removeListener(late)
    return {(r.symbol, r.minute_ts.minute): (r.open_price, r.close_price, r.tick_count)
            for r in spark.read.parquet(out + "/data").collect()}, dropped


def test_late_tick_is_dropped_and_last_bar_not_emitted(spark):
    m = lambda minute, sec: dt.datetime(2024, 1, 1, 10, minute, sec)
    bars, dropped = _run_bars_per_file(spark, [
        [("A", m(1, 5), 1.0, 1), ("A", m(1, 30), 2.0, 2)],
        [("A", m(2, 5), 3.0, 3)],
        [("A", m(1, 50), 9.0, 4)],          # late: minute 1 is already closed
        [("A", m(3, 1), 4.0, 5)],
    ])
    assert bars[("A", 1)] == (1.0, 2.0, 2)  # unchanged by the late tick
    assert bars[("A", 2)] == (3.0, 3.0, 1)
    assert ("A", 3) not in bars             # the open minute is never flushed
    assert dropped == 1


def test_emission_points_and_carry_over():
    rnd = np.random.default_rng(1)
    p = rnd.normal(100, 1, 500)
    idx, scores = emission_scores(np.empty(0), p, 0)
    n = idx + 1
    assert list(n[:4]) == [50, 100, 150, 200] and list(n[4:7]) == [201, 202, 203]
    assert np.isclose(scores[0], p[:50].std(ddof=1) * 1000)
    assert np.isclose(scores[-1], p[-200:].std(ddof=1) * 1000)
    # the same stream cut into two batches gives the same emissions
    i1, s1 = emission_scores(np.empty(0), p[:230], 0)
    i2, s2 = emission_scores(p[230 - 199:230], p[230:], 230)
    assert list(np.concatenate([i1, i2 + 230])) == list(idx)
    assert np.allclose(np.concatenate([s1, s2]), scores, rtol=0, atol=1e-9)


def test_risk_foreach_batch_upsert_keeps_first_ts(spark):
    from tickbook.streaming.risk import upsert_risk_batch
    t1, t2 = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 15)
    sch = "symbol string, risk_ts timestamp_ntz, seq long, tick_no long, risk_score double"
    path = os.path.join(tempfile.mkdtemp(prefix="tb-risk-"), "fact_symbol_risk")
    w = upsert_risk_batch(path)
    w(spark.createDataFrame([("A", t1, 1, 50, 1.0)], sch), 0)
    w(spark.createDataFrame([("A", t2, 9, 100, 2.0), ("B", t2, 10, 50, 3.0)], sch), 1)
    got = sorted((r.symbol, r.risk_ts, r.risk_score) for r in spark.read.parquet(path).collect())
    assert got == [("A", t1, 2.0), ("B", t2, 3.0)]


def test_parse_ticks_routes_bad_messages(spark):
    from tickbook.streaming.sources import parse_ticks
    msgs = spark.createDataFrame([
        (1, '{"symbol": "AAPL", "ts": 1704067200.5, "price": 101.25, "size": 7}'),
        (2, 'not json'),
        (3, '{"symbol": "", "ts": 1704067201.0, "price": 1.0, "size": 1}'),
        (4, '{"symbol": "MSFT", "ts": 1704067202.0, "size": 3}'),
    ], "seq long, value string")
    ticks, rejects = parse_ticks(msgs)
    got = [(r.seq, r.symbol, r.ts, r.price, r.size) for r in ticks.collect()]
    assert got == [(1, "AAPL", dt.datetime(2024, 1, 1, 0, 0, 0, 500000), 101.25, 7)]
    assert sorted(r.seq for r in rejects.collect()) == [2, 3, 4]


@pytest.mark.parametrize("lo,hi,batches_n", [(95, 105, 3), (50, 5000, 5)])
def test_stream_match_carries_resting_book_across_triggers(spark, lo, hi, batches_n):
    import random
    from decimal import Decimal

    import pandas as pd

    from tickbook.streaming.matching import sweep, stream_match
    rnd = random.Random(21)
    sch = ("order_id long, customer_id long, symbol string, side string, price decimal(18,2), "
           "created_at timestamp_ntz, open_qty long")
    t0 = dt.datetime(2024, 1, 1)
    batches = []
    oid = 0
    for b in range(batches_n):
        rows = []
        for _ in range(60):
            oid += 1
            rows.append((oid, 500 + oid, rnd.choice(["A", "B"]), rnd.choice(["BUY", "SELL"]),
                         Decimal(rnd.randint(lo, hi)), t0 + dt.timedelta(seconds=oid), rnd.randint(1, 30)))
        batches.append(rows)
    # expected: sweep each symbol's book batch after batch, carrying the residual
    want, resting = set(), {}
    for rows in batches:
        for sym in ("A", "B"):
            new = pd.DataFrame([{"order_id": r[0], "customer_id": r[1], "side": r[3], "cents": int(r[4]) * 100,
                                 "created_at": r[5], "open_qty": r[6]} for r in rows if r[2] == sym])
            book = pd.concat([resting.get(sym, new.iloc[0:0]), new], ignore_index=True)
            trades, resting[sym] = sweep(book)
            want |= {(int(b), int(s), int(q)) for b, s, q in
                     zip(trades["buy_order_id"], trades["sell_order_id"], trades["quantity"])}
    src = tempfile.mkdtemp(prefix="tb-orders-")
    out = tempfile.mkdtemp(prefix="tb-match-out-")
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(sch)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        s = spark.readStream.schema(schema).option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.parquet").parquet(src)
        q = (stream_match(s).writeStream.format("parquet").option("path", out + "/data")
             .option("checkpointLocation", out + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    got = {(r.buy_order_id, r.sell_order_id, r.quantity) for r in spark.read.parquet(out + "/data").collect()}
    assert got == want and len(got) > 0


def test_stream_match_append_path_then_cross(spark):
    from decimal import Decimal

    from pyspark.sql import types as T

    from tickbook.streaming.matching import stream_match
    sch = ("order_id long, customer_id long, symbol string, side string, price decimal(18,2), "
           "created_at timestamp_ntz, open_qty long")
    t0 = dt.datetime(2024, 1, 1)
    b1 = [(1, 11, "A", "BUY", Decimal(90), t0, 10), (2, 12, "A", "SELL", Decimal(110), t0, 5),
          (3, 13, "A", "SELL", Decimal(111), t0, 5)]                   # nothing crosses: appended
    b2 = [(4, 14, "A", "BUY", Decimal(120), t0 + dt.timedelta(seconds=1), 7)]  # takes 5 @110, 2 @111
    src, out = tempfile.mkdtemp(prefix="tb-orders-"), tempfile.mkdtemp(prefix="tb-match-out-")
    schema = T._parse_datatype_string(sch)
    for i, rows in enumerate([b1, b2]):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        s = spark.readStream.schema(schema).option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.parquet").parquet(src)
        q = (stream_match(s).writeStream.format("parquet").option("path", out + "/data")
             .option("checkpointLocation", out + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r.buy_order_id, r.sell_order_id, r.quantity, float(r.trade_price))
                 for r in spark.read.parquet(out + "/data").collect())
    assert got == [(4, 2, 5, 110.0), (4, 3, 2, 111.0)]


def test_best_price_in_an_unread_bucket_is_kept(spark):
    from decimal import Decimal

    from tickbook.streaming.matching import stream_match
    from tickbook.streaming.sources import parquet_stream, run_to_parquet
    sch = ("order_id long, customer_id long, symbol string, side string, price decimal(18,2), "
           "created_at timestamp_ntz, open_qty long")
    order = lambda i, side, px: (i, i, "A", side, Decimal(px), dt.datetime(2024, 1, 1, 0, 0, i), 1)
    folder = tempfile.mkdtemp(prefix="tb-orders-")
    # the second trigger trades above the resting buy at 100 and leaves one far below it
    for i, rows in enumerate([[order(1, "BUY", 100), order(2, "SELL", 200)], [order(3, "BUY", 210), order(4, "BUY", 50)],
                              [order(5, "SELL", 90)]]):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(os.path.join(folder, f"f={i}"))
    stream = parquet_stream(spark, folder, spark.createDataFrame([], sch).schema, max_files=1)
    out = run_to_parquet(stream_match(stream), "best-test")
    assert sorted((r.buy_order_id, r.sell_order_id) for r in spark.read.parquet(out).collect()) == [(1, 5), (3, 2)]


def test_stream_bars_foreach_batch_upsert_equals_batch_bars(spark):
    from pyspark.sql import functions as F

    from tickbook.operators.bars import bars
    from tickbook.sources import fixtures as fx
    from tickbook.streaming.bars import upsert_bars_batch
    from tickbook.streaming.sources import tick_stream

    from .conftest import SF001
    table = os.path.join(tempfile.mkdtemp(prefix="tb-bars-tbl-"), "fact_tick_agg")
    ck = tempfile.mkdtemp(prefix="tb-bars-ck-")
    q = (stream_bars(tick_stream(spark, SF001)).writeStream.foreachBatch(upsert_bars_batch(table))
         .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(table).drop("bar_day")
    t = fx.ticks(spark, SF001)
    last = t.agg(F.max("ts")).first()[0]
    want = bars(t).filter(F.col("minute_ts") + F.expr("INTERVAL 1 MINUTE") <= F.lit(last))
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_stream_risk_state_survives_restart(spark):
    from pyspark.sql import types as T

    from tickbook.streaming.risk import stream_risk
    rnd = np.random.default_rng(9)
    t0 = dt.datetime(2024, 1, 1)
    n = 700
    rows = [("S" if i % 3 else "T", t0 + dt.timedelta(seconds=i), float(100 + rnd.normal()), i) for i in range(n)]
    src, out = tempfile.mkdtemp(prefix="tb-ticks-"), tempfile.mkdtemp(prefix="tb-risk-out-")
    schema = T._parse_datatype_string(TICK)
    for i, part in enumerate([rows[:n // 2], rows[n // 2:]]):       # one query run per file
        spark.createDataFrame(part, TICK).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        s = spark.readStream.schema(schema).option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.parquet").parquet(src)
        q = (stream_risk(s).writeStream.format("parquet").option("path", out + "/data")
             .option("checkpointLocation", out + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r.symbol, r.tick_no, round(r.risk_score, 9)) for r in spark.read.parquet(out + "/data").collect())
    want = []
    for sym in ("S", "T"):
        p = np.array([r[2] for r in rows if r[0] == sym])
        idx, scores = emission_scores(np.empty(0), p, 0)
        want += [(sym, int(i) + 1, round(float(sc), 9)) for i, sc in zip(idx, scores)]
    assert got == sorted(want) and len(got) > 0


def _auctions(rows, days):
    """Orders one by one, interval after interval; the plainest possible matcher."""
    t0 = dt.datetime(1970, 1, 1)
    book, trades, at = [], [], {}
    for r in sorted(set(rows)):
        at.setdefault((r[5] - t0) // dt.timedelta(days=days), []).append(list(r))
    closed = sorted(at)[:-1]                                   # the last interval stays open
    for key in closed:
        book += at[key]
        for sym in sorted({r[2] for r in book}):
            buys = sorted((r for r in book if r[2] == sym and r[3] == "BUY"), key=lambda r: (-r[4], r[5], r[0]))
            sells = sorted((r for r in book if r[2] == sym and r[3] == "SELL"), key=lambda r: (r[4], r[5], r[0]))
            # cumulative quantities decide who meets whom; only crossing pairs trade
            b_at, pairs = 0, []
            for b in buys:
                s_at = 0
                for s in sells:
                    q = min(b_at + b[6], s_at + s[6]) - max(b_at, s_at)
                    if q > 0 and b[4] >= s[4]:
                        pairs.append((b, s, q))
                    s_at += s[6]
                b_at += b[6]
            for b, s, q in pairs:
                trades.append((b[0], s[0], q, s[4]))
                b[6] -= q
                s[6] -= q
        book = [r for r in book if r[6] > 0]
    return sorted(trades)


@pytest.mark.parametrize("files", [1, 3, 7])
def test_interval_auctions_do_not_depend_on_triggers(spark, files):
    import random
    from decimal import Decimal

    from tickbook.streaming.matching import stream_match
    from tickbook.streaming.sources import parquet_stream, run_to_parquet
    rnd = random.Random(5)
    sch = ("order_id long, customer_id long, symbol string, side string, price decimal(18,2), "
           "created_at timestamp_ntz, open_qty long")
    rows = [(i, 500 + i, rnd.choice("AB"), rnd.choice(["BUY", "SELL"]), Decimal(rnd.randint(95, 105)),
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=3 * i + rnd.randint(0, 9)), rnd.randint(1, 30)) for i in range(210)]
    rows.append((999, 1, "A", "BUY", Decimal(1), dt.datetime(2024, 3, 1), 1))      # closes all before it
    want = _auctions(rows, 2)
    folder = tempfile.mkdtemp(prefix="tb-auction-")
    step = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * step:(i + 1) * step]
        again = rows[max(0, i * step - 4):i * step]                               # delivered before
        spark.createDataFrame(part + again, sch).coalesce(1).write.parquet(os.path.join(folder, f"f={i}"))
    stream = parquet_stream(spark, folder, spark.createDataFrame(rows, sch).schema, max_files=1)
    out = run_to_parquet(stream_match(stream, dt.timedelta(days=2), "2 days"), "auction-test")
    got = sorted((r.buy_order_id, r.sell_order_id, r.quantity, r.trade_price) for r in spark.read.parquet(out).collect())
    assert got == want and len(got) > 20


def test_interval_query_equals_plain_auctions(spark):
    from tickbook.plans.registry import AUCTION_INTERVAL, QUERIES
    from tickbook.sources import fixtures as fx

    from .conftest import SF001
    rows = [tuple(r) for r in fx.book(spark, SF001).select("order_id", "customer_id", "symbol", "side", "price", "created_at",
                                                         "quantity").collect()]
    got = sorted((r.buy_order_id, r.sell_order_id, r.quantity, r.trade_price)
                 for r in QUERIES["stream_match_intervals"](spark, SF001).collect())
    assert got == _auctions(rows, AUCTION_INTERVAL.days) and len(got) > 100


def test_order_messages_are_parsed_or_rejected(spark):
    from tickbook.streaming.sources import parse_orders
    good = '{"order_id":1,"customer_id":2,"symbol":"A","side":"BUY","qty":3,"price":4.50}'
    bad = ["no json", "{}", None, good.replace("BUY", "HOLD"), good.replace("3", "0")]
    t = dt.datetime(2024, 1, 1)
    orders, rejects = parse_orders(spark.createDataFrame([(t, v) for v in [good, *bad]], "timestamp timestamp_ntz, value string"))
    assert [(r.order_id, r.side, r.open_qty, float(r.price), r.created_at) for r in orders.collect()] == [(1, "BUY", 3, 4.5, t)]
    assert rejects.count() == len(bad)


def test_scores_hold_no_window_of_every_tick():
    import tracemalloc
    p = np.random.default_rng(3).normal(100, 1, 300_000)
    tracemalloc.start()
    idx, scores = emission_scores(np.empty(0), p, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20                                     # all windows: 480 MB
    for i in (0, 3, 4, 4099, 4100, len(idx) - 1):
        assert np.isclose(scores[i], p[max(0, idx[i] - 199):idx[i] + 1].std(ddof=1) * 1000)


class _State:
    """A state variable (map or value) and the handle that makes them, in memory."""

    def __init__(self):
        self.kept, self.made, self.timers = {}, {}, set()

    def getMapState(self, name, *_):
        return self.made.setdefault(name, _State())

    getValueState = getListState = getMapState

    def registerTimer(self, at):
        self.timers.add(at)

    def exists(self):
        return bool(self.kept)

    def get(self):
        return self.kept[None]

    def update(self, value):
        self.kept[None] = value

    def put(self, rows):
        self.kept[None] = rows

    def keys(self):
        return list(self.kept)

    def getValue(self, key):
        return self.kept[key]

    def updateValue(self, key, value):
        self.kept[key] = value

    def removeKey(self, key):
        del self.kept[key]


def _orders_frame(n, seed=5):
    from decimal import Decimal

    import pandas as pd
    rng = np.random.default_rng(seed)
    at = np.datetime64("2024-01-01", "us") + np.sort(rng.integers(0, 50_000, n)).astype("timedelta64[s]")
    return pd.DataFrame({"symbol": "A", "order_id": np.arange(n), "customer_id": rng.integers(0, 9, n),
                         "side": np.where(rng.random(n) < .5, "BUY", "SELL").astype(object),
                         "price": [Decimal(int(x)).scaleb(-2) for x in rng.integers(9000, 11000, n)], "created_at": at,
                         "open_qty": rng.integers(1, 30, n), "at_ms": at.astype("datetime64[ms]").astype("int64")})


def test_due_auctions_are_matched_in_turn(monkeypatch):
    """However many auctions are due at once: the same trades, few orders held."""
    import pandas as pd

    from tickbook.streaming import matching

    class Timer:
        def getCurrentWatermarkInMs(self):
            return 1 << 60

        getExpiryTimeInMs = getCurrentWatermarkInMs
    results, held = [], []
    for due in (1 << 20, 100):
        monkeypatch.setattr(matching, "DUE_ROWS", due)
        m = matching.IntervalMatcher(3_600_000)
        m.init(_State())
        rows = _orders_frame(900)
        list(m.handleInputRows(("A",), iter([rows[:500], rows[500:]]), None))
        match = m._match
        seen = []
        m._match = lambda symbol, auctions: (seen.append(sum(map(len, auctions))), match(symbol, auctions))[1]  # noqa: B023
        results.append(pd.concat(list(m.handleExpiredTimer(("A",), Timer(), Timer())), ignore_index=True))
        held.append(seen)
        assert not m.waiting.keys()
    assert held[0] == [900] and max(held[1]) < 250 and sum(held[1]) == 900
    assert len(results[0]) > 100 and results[0].astype(str).equals(results[1].astype(str))


def test_trades_leave_in_frames_of_bounded_size(monkeypatch):
    import pandas as pd

    from tickbook.streaming import matching
    monkeypatch.setattr(matching, "OUT_ROWS", 50)
    m = matching.BookMatcher()
    m.init(_State())
    rows = _orders_frame(600)
    frames = list(m.handleInputRows(("A",), iter([rows[:400], rows[400:]]), None))
    want, _ = matching.sweep(matching._new_orders(rows))
    got = pd.concat(frames, ignore_index=True)
    assert max(map(len, frames)) == 50 and len(got) == len(want) > 100
    assert got["quantity"].tolist() == want["quantity"].tolist()
    assert [int(p * 100) for p in got["trade_price"]] == want["cents"].tolist()


def test_risk_of_a_symbol_in_unordered_batches(monkeypatch):
    import pandas as pd

    from tickbook.streaming import risk
    monkeypatch.setattr(risk, "OUT_ROWS", 64)
    rng = np.random.default_rng(2)
    ticks = pd.DataFrame({"symbol": "A", "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 99, 700), unit="s"),
                          "seq": rng.permutation(700), "price": rng.normal(100, 1, 700)})
    r = risk.RollingRisk()
    r.init(_State())
    frames = list(r.handleInputRows(("A",), iter([ticks[:300], ticks[300:]]), None))
    got = pd.concat(frames, ignore_index=True)
    ordered = ticks.sort_values(["ts", "seq"], ignore_index=True)
    idx, scores = emission_scores(np.empty(0), ordered["price"].to_numpy(), 0)
    assert max(map(len, frames)) == 64 and got["tick_no"].tolist() == (idx + 1).tolist()
    assert got["seq"].tolist() == ordered["seq"][idx].tolist() and np.array_equal(got["risk_score"], scores)
    assert (got["risk_ts"].to_numpy() == ordered["ts"].to_numpy()[idx]).all()
