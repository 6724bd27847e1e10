"""The outbox as a streaming source with its own offsets, and the topics as a sink."""

import datetime as dt
import os

import pyarrow as pa
import pytest

from tickbook.session import scratch_path
from tickbook.streaming import outbox_source as src

SCHEMA = "event_id bigint, event_type string, payload string, created_ts timestamp_ntz, dispatched string"


def events(spark, ids):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, "ORDER_CREATED" if i % 2 else "TRADE_EXECUTED",
                                   "broken" if i % 10 == 0 else f'{{"symbol":"S{i % 3}"}}', t + dt.timedelta(seconds=i),
                                   "Y" if i % 7 == 0 else "N") for i in ids], SCHEMA)


def plain(path):
    return path.removeprefix("file:")


def wanted(ids):
    return sorted((i, "order_events" if i % 2 else "trade_events", f"S{i % 3}") for i in ids if i % 7 and i % 10)


def found(spark, sink):
    return sorted((r.event_id, r.topic, r.key) for r in spark.read.parquet(sink).collect())


def test_a_restart_repeats_nothing(spark):
    table, sink, check = (scratch_path(spark, x) for x in ("os-table", "os-sink", "os-check"))
    for lo, hi in ((1, 120), (121, 123), (124, 400)):
        events(spark, range(lo, hi + 1)).write.mode("append").parquet(table)
        src.publish_topics(spark, table, sink, check, step=50).awaitTermination()
        assert found(spark, sink) == wanted(range(1, hi + 1))
    src.publish_topics(spark, table, sink, check).awaitTermination()              # nothing new
    assert found(spark, sink) == wanted(range(1, 401))
    assert not [f for f in os.listdir(plain(sink) + "/_staging") if f.endswith(".parquet")]


def test_ranges_cover_all_ids_once(spark):
    table = scratch_path(spark, "os-table")
    events(spark, range(1, 301)).repartition(5).write.parquet(table)
    reader = src.OutboxReader({"path": table, "step": "64"})
    end = reader.latestOffset()
    assert end == {"event_id": 300} and reader.initialOffset() == {"event_id": -1}
    parts = reader.partitions({"event_id": 10}, end)
    assert [(p.after, p.until) for p in parts] == [(10, 74), (74, 138), (138, 202), (202, 266), (266, 300)]
    ids = [i for p in parts for b in reader.read(p) for i in b.column(0).to_pylist()]
    assert sorted(ids) == list(range(11, 301))
    assert reader.partitions(end, end) == []


def test_a_large_batch_reads_every_row_group_once(spark, monkeypatch):
    """Ids in any order in the files, and ids far apart: as many tasks as the rows need."""
    table = scratch_path(spark, "os-table")
    ids = [i * (1 if i < 150 else 10 ** 6) for i in range(1, 301)]
    events(spark, ids).repartition(5).write.parquet(table)
    reader = src.OutboxReader({"path": table, "step": "40"})
    assert len(reader.partitions({"event_id": -1}, {"event_id": 149})) == 4        # few ids: ranges of them
    end = reader.latestOffset()
    parts = reader.partitions({"event_id": 10}, end)
    groups = [(f, g) for p in parts for f, gs in p.groups for g in gs]
    assert len(parts) == 5 and len(groups) == len(set(groups)) == 5
    monkeypatch.setattr(reader, "_files", None)                                   # no task lists the table
    assert sorted(i for p in parts for b in reader.read(p) for i in b.column(0).to_pylist()) == ids[10:]
    monkeypatch.undo()
    assert reader.partitions({"event_id": ids[-1]}, {"event_id": ids[-1] + 1000}) == []


def test_old_row_groups_are_not_read_again(spark):
    table = scratch_path(spark, "os-table")
    events(spark, range(1, 401)).repartition(2).write.parquet(table)
    events(spark, range(401, 801)).repartition(3).write.mode("append").parquet(table)
    reader = src.OutboxReader({"path": table, "step": "20"})
    parts = reader.partitions({"event_id": 400}, {"event_id": 800})
    assert sum(len(g) for p in parts for _, g in p.groups) == 3
    assert sorted(i for p in parts for b in reader.read(p) for i in b.column(0).to_pylist()) == list(range(401, 801))


def test_unfinished_and_new_files_wait(spark):
    table = scratch_path(spark, "os-table")
    assert src.OutboxReader({"path": table}).latestOffset() == {"event_id": -1}   # no table yet
    events(spark, range(1, 11)).write.parquet(table)
    events(spark, range(11, 21)).write.parquet(table + "/_temporary/x")           # a job that has not ended
    assert src.OutboxReader({"path": table}).latestOffset() == {"event_id": 10}
    assert src.OutboxReader({"path": table, "ignoreNewerThan": "3600"}).latestOffset() == {"event_id": -1}


def test_a_batch_committed_twice_is_there_once(spark):
    sink = plain(scratch_path(spark, "os-sink"))
    writer = src.TopicWriter(sink)
    rows = pa.RecordBatch.from_pydict({"event_id": [1, 2, 3], "topic": ["a", "b", "a"], "key": ["x", "y", "z"], "value": ["1", "2", "3"]})
    first, lost = writer.write(iter([rows])), writer.write(iter([rows]))           # the second attempt of a task does not count
    writer.abort([lost], 0)
    writer.commit([first, None], 0)
    writer.commit([first, None], 0)                                               # the driver repeats its commit
    writer.commit([writer.write(iter([rows]))], 0)                                # the batch is replayed
    assert sorted((r.event_id, r.topic) for r in spark.read.parquet(sink).collect()) == [(1, "a"), (2, "b"), (3, "a")]
    assert os.listdir(sink + "/_staging") == []


@pytest.mark.parametrize("path, kind", [("/a/b", "/a/b"), ("file:/a/b", "/a/b"), ("file:///a/b", "/a/b")])
def test_places(path, kind):
    assert src._place(path)[1] == kind
