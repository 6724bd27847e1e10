"""The outbox as a streaming source, and the topics as a sink, with offsets of their own.

``outbox`` (source): the outbox table in order of event id.  An offset is an
event id, so a batch is a range of ids and a query goes on where its
checkpoint ended: no event twice, none left out, and no ledger to keep.  A
batch reads every row group that can hold one of its ids once: its tasks take
about ``step`` rows of row groups each, whatever the order of ids in the files.
Up to ``SMALL`` times as many ids are cut into ranges of ``step`` ids instead.

    spark.dataSource.register(OutboxSource)
    spark.readStream.format("outbox").option("path", table).load()

Events must become visible in order of id: one append at a time, seen at once
(a finished folder renamed into the table, for one), or old enough: with
``ignoreNewerThan`` the files of the last so many seconds wait.

``outbox_topics`` (sink): rows (topic, key, value, event_id) to one Parquet
folder per topic.  Tasks write below ``_staging``, which readers do not see;
the commit moves the files of the tasks that count to names made of the batch
and their place, so a batch that is committed again, after a crash during the
commit or a replay, replaces its own files.

Both sides reach the files through Arrow's file systems (local, HDFS, object
stores), from the tasks; nothing but the newest id and the file names passes
the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import (DataSource, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from ..schemas import DDL

STEP = 1 << 16             # rows of one task (or ids, in a small batch)
SMALL = 8                  # steps of a small batch
_ROWS = 1 << 14            # rows of one Arrow batch
_UNITS = pa.timestamp("us")
_ARROW = {"event_id": pa.int64(), "event_type": pa.string(), "payload": pa.string(), "created_ts": _UNITS, "dispatched": pa.string()}
TOPIC_SCHEMA = "event_id bigint, topic string, key string, value string"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class OutboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "outbox"

    def schema(self) -> str:
        return DDL["outbox_events"]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return OutboxReader(self.options)


@dataclass
class IdRange(InputPartition):
    """Events with after < event_id <= until, of the given row groups (None: of all files)."""

    after: int
    until: int
    groups: list[tuple[str, list[int]]] | None = None
    schema: pa.Schema | None = None


class OutboxReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.start = int(options.get("startingAfter", -1))
        self.step = int(options.get("step", STEP))
        self.wait = float(options.get("ignoreNewerThan", 0))

    def _files(self) -> ds.Dataset | None:
        fs, path = _place(self.path)
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        old = time.time() - self.wait
        found = [f.path for f in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(".parquet")
                 and (not self.wait or f.mtime.timestamp() <= old)
                 and not any(part[:1] in "_." for part in f.path.removeprefix(path).strip("/").split("/"))]
        return ds.dataset(sorted(found), filesystem=fs, format="parquet") if found else None

    def initialOffset(self) -> dict:
        return {"event_id": self.start}

    def _row_groups(self, files: ds.Dataset | None) -> Iterator[tuple[str, int, int, int | None, int | None]]:
        """(file, row group, rows, smallest id, largest id) from the footers; ids that no
        statistics tell are None."""
        for fragment in files.get_fragments() if files else ():
            for group in fragment.row_groups:
                known = (group.statistics or {}).get("event_id") or {}
                yield fragment.path, group.id, group.num_rows, known.get("min"), known.get("max")

    def latestOffset(self) -> dict:
        """The newest id, from the files' statistics."""
        newest = self.start
        files = self._files()
        for path, group, rows, _, largest in self._row_groups(files):
            if largest is not None:
                newest = max(newest, largest)
            elif rows:
                one = files.format.make_fragment(path, files.filesystem, row_groups=[group])
                ids = one.to_table(columns=["event_id"]).column(0)
                newest = max(newest, pa.compute.max(ids).as_py() or newest)
        return {"event_id": newest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["event_id"], end["event_id"]
        if hi <= lo:
            return []
        files = self._files()
        wanted = sorted(((least if least is not None else lo, path, group, rows)
                         for path, group, rows, least, largest in self._row_groups(files)
                         if rows and (largest is None or least <= hi and largest > lo)))
        if max(hi - lo, sum(w[3] for w in wanted)) <= SMALL * self.step:
            return [IdRange(a, min(a + self.step, hi)) for a in range(lo, hi, self.step)]
        tasks: list[dict[str, list[int]]] = []
        held = self.step
        for _, path, group, rows in wanted:
            if held + rows > self.step:
                tasks.append({})
                held = 0
            tasks[-1].setdefault(path, []).append(group)
            held += rows
        return [IdRange(lo, hi, list(t.items()), files.schema) for t in tasks]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        if partition.groups is None:
            files = self._files()
        else:
            fs, form = _place(self.path)[0], ds.ParquetFileFormat()
            files = ds.FileSystemDataset([form.make_fragment(f, fs, row_groups=ids) for f, ids in partition.groups],
                                         partition.schema, form, fs)
        if files is None:
            return
        wanted = (ds.field("event_id") > partition.after) & (ds.field("event_id") <= partition.until)
        schema = pa.schema(list(_ARROW.items()))
        # few batches ahead: a row group may hold many
        for batch in files.scanner(columns=list(_ARROW), filter=wanted, batch_size=_ROWS, batch_readahead=2,
                                   fragment_readahead=1).to_batches():
            if batch.num_rows:
                yield batch.cast(schema)


class TopicSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "outbox_topics"

    def schema(self) -> str:
        return TOPIC_SCHEMA

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return TopicWriter(self.options["path"])


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: (topic, name below ``_staging``)."""

    files: list[tuple[str, str]]


class TopicWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, path = _place(self.path)
        stage = f"{path}/_staging"
        fs.create_dir(stage, recursive=True)
        writers: dict[str, pq.ParquetWriter] = {}
        files: list[tuple[str, str]] = []
        try:
            for batch in iterator:
                rows = pa.Table.from_batches([batch])
                for topic in pa.compute.unique(rows.column("topic")).to_pylist():
                    mine = rows.filter(pa.compute.equal(rows.column("topic"), topic)).drop_columns("topic")
                    if topic not in writers:
                        files.append((topic, f"{uuid.uuid4().hex}.parquet"))
                        writers[topic] = pq.ParquetWriter(f"{stage}/{files[-1][1]}", mine.schema, filesystem=fs)
                    writers[topic].write_table(mine)
        finally:
            for w in writers.values():
                w.close()
        return Staged(files)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, path = _place(self.path)
        for place, message in enumerate(messages):
            for topic, name in message.files if message else ():
                folder = f"{path}/topic={topic}"
                fs.create_dir(folder, recursive=True)
                if fs.get_file_info(f"{path}/_staging/{name}").type != pafs.FileType.NotFound:     # else moved before a crash
                    fs.move(f"{path}/_staging/{name}", f"{folder}/part-{batchId:010d}-{place:05d}.parquet")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, path = _place(self.path)
        for message in messages:
            for _, name in message.files if message else ():
                if fs.get_file_info(f"{path}/_staging/{name}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{path}/_staging/{name}")


def register(spark) -> None:
    """Make both formats known to the session."""
    spark.dataSource.register(OutboxSource)
    spark.dataSource.register(TopicSink)


def publish_topics(spark, table: str, sink: str, checkpoint: str, **options):
    """Start the publisher: pending events of the outbox ``table`` that can be routed, to ``sink``."""
    from ..operators.outbox import pending, routable, route
    register(spark)
    reader = spark.readStream.format("outbox").option("path", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    events = pending(reader.load()).where(routable())
    return (route(events).select("event_id", "topic", "key", "value").writeStream.format("outbox_topics").option("path", sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
