"""SparkSession defaults and the shared scratch folder.

Everything the engine materialises (fixture tables, upsert targets, stream
checkpoints, CSV exports) goes below ``spark.checkpoint.dir`` so that a lost
executor never takes a needed file with it.  The setting is read from the
session; a local folder is created only when it is unset *and* the session
runs in local mode (tests, the bench).
"""

from __future__ import annotations

import contextlib
import contextvars
import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: deterministic time zone, ANSI semantics,
# adaptive execution (runtime broadcast only below a measured size, partition
# coalescing, skew-join splitting) and the RocksDB store for keyed state.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20,
               rows_per_range_partition: int = 4_000_000) -> dict:
    """Settings for a run over ``input_bytes`` of input.

    Shuffles start with one partition per ``partition_bytes`` of input (AQE
    coalesces small ones, it cannot split big ones), scans split files at the
    same size, and AQE aims for that size after coalescing; skew splitting
    starts at 4x the target.  About 400,000 shuffle partitions for 100 TB."""
    n = max(200, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "tickbook.rangeRowsPerPartition": str(rows_per_range_partition),
    }


def build_session(master: str | None = None, app: str = "tickbook",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickbook`` importable in the Python workers (``mapInPandas``,
    the streaming state processors), like ``spark-submit --py-files``.

    The package is zipped once per application into a driver-side staging
    file; Spark's file server distributes it and every executor caches its
    own copy, so nothing reads that file but the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tickbook-pyfiles-"), "tickbook.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    # the driver-side Python runner of the streaming state processors takes
    # its path from the function environment, not from addPyFile
    prev = sc.environment.get("PYTHONPATH")
    sc.environment["PYTHONPATH"] = out + (os.pathsep + prev if prev else "")
    _shipped.add(sc.applicationId)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL confs that can change at runtime (for sessions built elsewhere)
    and ship the package to the Python workers."""
    ship_package(spark)
    for k, v in DEFAULT_CONF.items():
        if k != _STATE_PROVIDER or spark.conf.get(k, None) in (None, ""):   # a chosen state store stays
            spark.conf.set(k, v)


RANGE_ROWS_CONF = "tickbook.rangeRowsPerPartition"
DEFAULT_RANGE_ROWS = 4_000_000


def range_partitions(spark: SparkSession, rows: int) -> int:
    """Partition count for an explicit range repartitioning of ``rows`` rows.

    AQE can coalesce but not split range partitions, so the count follows the
    data: one partition per ``tickbook.rangeRowsPerPartition`` rows (default
    4M), never fewer than ``spark.sql.shuffle.partitions``."""
    per = int(spark.conf.get(RANGE_ROWS_CONF, str(DEFAULT_RANGE_ROWS)))
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(base, -(-int(rows) // max(per, 1)))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_BATCHES_KEPT = "spark.sql.streaming.minBatchesToRetain"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession, batches_kept: int | None = None):
    """Start stateful queries (transformWithStateInPandas needs RocksDB) with the
    RocksDB state store, whatever the session uses; the setting is captured
    when a query starts, so the session's own value is restored afterwards.
    ``batches_kept``: how many of the last batches can be recovered from the
    checkpoint (default: the session's setting); the state of older ones is deleted."""
    prev, kept = spark.conf.get(_STATE_PROVIDER, None), spark.conf.get(_BATCHES_KEPT, None)
    spark.conf.set(_STATE_PROVIDER, ROCKSDB)
    if batches_kept is not None:
        spark.conf.set(_BATCHES_KEPT, str(batches_kept))
    try:
        yield
    finally:
        if prev and prev != ROCKSDB:
            spark.conf.set(_STATE_PROVIDER, prev)
        if batches_kept is not None:
            spark.conf.unset(_BATCHES_KEPT) if kept is None else spark.conf.set(_BATCHES_KEPT, kept)


def release_shuffles(spark: SparkSession) -> None:
    """Have the JVM collect, so that Spark deletes the shuffle files of plans that nothing holds any
    more: a stream's batches do not delete theirs (``scratch_freed`` does it for batch jobs)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def concurrent_folders(spark: SparkSession, n: int):
    """Within it, a write into at most ``n`` partition folders keeps a file open in each, and
    does not sort its rows by folder (Spark sorts where there are more)."""
    prev = spark.conf.get(_CONCURRENT_WRITERS)
    spark.conf.set(_CONCURRENT_WRITERS, str(n))
    try:
        yield
    finally:
        spark.conf.set(_CONCURRENT_WRITERS, prev)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; created locally only for local sessions."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tickbook-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, in order; none if it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder, in milliseconds."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path`` by renaming (both on one file system).

    The folder replaced stays as ``<path>.previous`` until the next
    replacement; if the job dies between the two renames, it is there."""
    jvm = spark.sparkContext._jvm
    new_, path_, before = (jvm.org.apache.hadoop.fs.Path(x) for x in (new, path, path.rstrip("/") + ".previous"))
    fs = path_.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path_):
        fs.delete(before, True)
        if not fs.rename(path_, before):
            raise OSError(f"cannot rename {path}")
    elif path_.getParent() is not None:
        fs.mkdirs(path_.getParent())
    if not fs.rename(new_, path_):
        raise OSError(f"cannot rename {new} to {path}")


_scope: contextvars.ContextVar[list[tuple[str, str]] | None] = contextvars.ContextVar("tickbook_scratch", default=None)
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "tickbook", f"{label}-{uuid.uuid4().hex[:12]}")
    if (made := _scope.get()) is not None:
        made.append((label, path))
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch_freed(spark: SparkSession, keep: str | None = None):
    """The steps between two written tables: at its end the scratch folders made within it are
    deleted, and each action run within it removes its shuffle files when it ends.

    What is read afterwards goes to a folder made before it.  Folders whose label begins with
    ``keep`` stay too, and belong to the block around this one, if there is one."""
    made: list[tuple[str, str]] = []
    token = _scope.set(made)
    prev = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if prev is None else spark.conf.set(_SHUFFLE_CLEANUP, prev)
        _scope.reset(token)
        for label, path in made:
            if keep is None or not label.startswith(keep):
                drop_folder(spark, path)
            elif (outer := _scope.get()) is not None:
                outer.append((label, path))


@contextlib.contextmanager
def scratch_kept():
    """Within it, a block around it does not delete what is made: tables that the session keeps."""
    token = _scope.set(None)
    try:
        yield
    finally:
        _scope.reset(token)
