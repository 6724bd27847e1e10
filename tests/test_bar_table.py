"""Bars that late ticks correct, and streams that keep what they reject."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickbook.operators import bar_table, bars
from tickbook.session import folders, scratch_path
from tickbook.streaming import rejects
from tickbook.streaming.bars import late_bars

T0 = dt.datetime(2024, 1, 1, 23, 57)
SCHEMA = "symbol string, ts timestamp_ntz, seq bigint, price double, size bigint"


def ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_ticks(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["A", "B"]), T0 + dt.timedelta(seconds=rng.randrange(600) // 5 * 5), i, rng.randrange(1, 999) / 10, rng.randrange(5))
            for i in range(n)]                               # many ticks of one time: seq decides


def rows(df):
    return sorted(tuple(r) for r in df.select("symbol", "minute_ts", "open_price", "high_price", "low_price", "close_price",
                                              "volume", "tick_count", "traded_size").collect())


@pytest.mark.parametrize("compact_every", [1, 2, 100])
def test_late_ticks_correct_their_bars(spark, compact_every):
    data = random_ticks(compact_every, 500)
    table = scratch_path(spark, "bar-table")
    write = late_bars(table, compact_every)
    for batch in range(5):
        part = ticks(spark, data[batch::5])
        write(part, batch)
        if batch == 3:
            write(part, batch)                                                   # the batch is replayed
        so_far = [r for b in range(batch + 1) for r in data[b::5]]
        assert rows(bar_table.read_bars(spark, table)) == rows(bars.bars(ticks(spark, so_far), with_size=True))


def test_a_crash_between_parts_and_base_changes_nothing(spark):
    data = random_ticks(7, 300)
    want = rows(bars.bars(ticks(spark, data), with_size=True))
    table = scratch_path(spark, "bar-table")
    for batch in range(3):
        bar_table.add(bar_table.bar_parts(ticks(spark, data[batch::3])), table, batch)
    half = bar_table.bar_parts(ticks(spark, data[:50])).withColumn("bar_day", F.to_date("minute_ts"))
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("bar_day").parquet(f"{table}/base=2")
    assert rows(bar_table.read_bars(spark, table)) == want                      # an unfinished base is not read
    bar_table.compact(spark, table)
    assert rows(bar_table.read_bars(spark, table)) == want
    bar_table.add(bar_table.bar_parts(ticks(spark, data[2::3])), table, 2)      # the stream repeats its last batch
    assert rows(bar_table.read_bars(spark, table)) == want and bar_table.newest_base(spark, table) == 2


def test_compaction_rewrites_only_the_days_with_new_ticks(spark):
    table = scratch_path(spark, "bar-table")
    days = [("A", dt.datetime(2024, 1, d, 9, 30), d, 10.0 + d, 1) for d in range(1, 6)]
    bar_table.add(bar_table.bar_parts(ticks(spark, days)), table, 0)
    bar_table.compact(spark, table)
    bar_table.add(bar_table.bar_parts(ticks(spark, [("A", dt.datetime(2024, 1, 2, 9, 30, 30), 99, 1.0, 1)])), table, 1)
    bar_table.compact(spark, table)
    assert len(folders(spark, f"{table}/base=0")) == 5 and folders(spark, f"{table}/base=1") == ["bar_day=2024-01-02"]
    got = {r.minute_ts.day: (r.open_price, r.low_price, r.close_price, r.tick_count) for r in bar_table.read_bars(spark, table).collect()}
    assert got[2] == (12.0, 1.0, 1.0, 2) and got[3] == (13.0, 13.0, 13.0, 1) and len(got) == 5
    assert {r.minute_ts.day for r in bar_table.read_bars(spark, table, dt.date(2024, 1, 4)).collect()} == {4, 5}


def test_empty_batches_and_an_empty_table(spark):
    table = scratch_path(spark, "bar-table")
    assert rows(bar_table.read_bars(spark, table)) == []
    late_bars(table, 1)(ticks(spark, []), 0)
    assert rows(bar_table.read_bars(spark, table)) == []
    late_bars(table, 1)(ticks(spark, [("", T0, 1, 1.0, 1), ("A", T0, 2, None, 1), ("A", T0, 3, 5.0, None)]), 1)
    assert [(r[0], r[2], r[6]) for r in rows(bar_table.read_bars(spark, table))] == [("A", 5.0, 1)]


# --- rejects

def messages(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq bigint, value string")


GOOD = '{"symbol":"A","ts":1704067200,"price":1.5,"size":2}'
BAD = ['{"symbol":"A","ts":17', "", None, '{"symbol":"","ts":1704067200,"price":1.5}', '{"symbol":"A","ts":1704067200}', "[1]"]


def test_rows_rejects_and_error_row_of_a_batch(spark):
    out, audit = scratch_path(spark, "sinks"), scratch_path(spark, "sinks-audit")
    when = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    write = rejects.two_sinks(rejects.KINDS["ticks"][0], out, audit, "consumer", lambda: when)
    assert rejects.rejected(spark, out).isEmpty() and rejects.good_ticks(spark, out).isEmpty()
    write(messages(spark, [GOOD, *BAD, GOOD]), 0)
    write(messages(spark, [GOOD] * 3), 1)
    write(messages(spark, [GOOD, *BAD, GOOD]), 0)                               # replayed
    write(messages(spark, []), 2)
    assert rejects.good_ticks(spark, out).count() == 5
    got = sorted((r.batch, r.seq, r.raw) for r in rejects.rejected(spark, out).collect())
    assert got == [(0, i + 1, BAD[i]) for i in range(len(BAD))]
    row, = rejects.audit_rows(spark, audit).collect()
    assert (row.err_id, row.component, row.message) == (0, "consumer", "batch 0: 6 of 8 messages rejected")


def test_reject_stream_goes_on_from_its_checkpoint(spark):
    out, audit, source = (scratch_path(spark, x) for x in ("sinks", "sinks-audit", "sinks-source"))
    schema = messages(spark, []).schema
    for i in range(2):
        messages(spark, [GOOD, BAD[0], f"x{i}"]).write.mode("append").parquet(source)
        rejects.keep_rejects(spark.readStream.schema(schema).parquet(source), out, audit, "consumer").awaitTermination()
    assert sorted(r.raw for r in rejects.rejected(spark, out).collect()) == sorted([BAD[0], BAD[0], "x0", "x1"])
    assert rejects.good_ticks(spark, out).count() == 2 and rejects.audit_rows(spark, audit).count() == 2


def test_rejected_orders_keep_their_text(spark):
    out, audit = scratch_path(spark, "sinks"), scratch_path(spark, "sinks-audit")
    t = dt.datetime(2024, 1, 1)
    good = '{"order_id":1,"customer_id":2,"symbol":"A","side":"BUY","qty":3,"price":4.5}'
    bad = [good.replace("BUY", "HOLD"), good.replace('"qty":3', '"qty":0'), "{"]
    m = spark.createDataFrame([(t, good), *((t, b) for b in bad)], "timestamp timestamp, value string")
    rejects.two_sinks(rejects.KINDS["orders"][0], out, audit, "engine")(m, 4)
    assert sorted(r.raw for r in rejects.rejected(spark, out, "orders").collect()) == sorted(bad)


def test_a_companion_keeps_only_the_rejects(spark):
    out, audit = scratch_path(spark, "sinks"), scratch_path(spark, "sinks-audit")
    write = rejects.two_sinks(rejects.KINDS["ticks"][0], out, audit, "consumer", rows=False)
    write(messages(spark, [GOOD, *BAD, GOOD]), 0)
    assert rejects.good_ticks(spark, out).isEmpty() and rejects.rejected(spark, out).count() == len(BAD)
    assert rejects.audit_rows(spark, audit).first().message == "batch 0: 6 of 8 messages rejected"
