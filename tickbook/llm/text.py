"""Helpers shared by the text operators: words and shingles as numpy hashes,
chunked Arrow batches, written intermediates, bounded labelled samples.

Word hashing is vectorised over a UTF-8 buffer: every byte is mapped to a
random 64-bit number, a running sum of those numbers times powers of an odd
base gives each word's polynomial by one subtraction, and a finaliser mixes
it.  Buffers are cut at separators into blocks of about ``BLOCK`` bytes, so
the working memory does not grow with the text.
"""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import apply_runtime_conf, scratch_path

BLOCK = 1 << 18
BATCH_ROWS = 128
MOST_IDS = 1 << 20       # ids of a sample that are broadcast; more are joined
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}

# ASCII white space: space, tab, line feed, vertical tab, form feed, return
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: the package on the workers, and
    Arrow batches small enough for texts of 100 KB and more."""
    apply_runtime_conf(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back (cuts lineage,
    survives lost executors, and gives later stages a known size)."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_bucket(col: Column | str, buckets: int) -> Column:
    """``crc32(doc_id as text) mod buckets``; NULL ids are in no bucket."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(buckets))


def py_bucket(doc_id, buckets: int) -> int | None:
    return None if doc_id is None else binascii.crc32(str(doc_id).encode()) % buckets


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    where: Column | None = None) -> DataFrame:
    """Texts of at most ``per_class`` labelled documents per value of ``label``: doc_id, text (NULL as empty), y.

    Only labels of ids that ``docs`` has are picked from, by the smallest hash, so the
    result depends on neither partitioning nor order.  An id with several labels has the
    smallest; an id with several texts is represented by the smallest, so every
    document is there once.  All values of the label are sampled, however many."""
    lab = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")) \
                .where(F.col("_id").isNotNull() & F.col("y").isNotNull())
    if where is not None:
        lab = lab.where(where)
    there = docs.select(F.col("doc_id").alias("_there"))
    lab = lab.join(there, F.col("_id") == F.col("_there"), "left_semi").groupBy("_id").agg(F.min("y").alias("y"))
    lab = stored(lab.withColumn("_h", F.xxhash64("_id", F.lit(label))), "labels-there")
    # hashes are even: of a large class only a little more than the wanted share goes on to be ranked
    n = lab.groupBy(F.col("y").alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    share = (per_class + 10 * per_class ** 0.5 + 50) / F.col("_n")
    lab = lab.join(n, F.col("y") == F.col("_y")).where(F.col("_h") / 2.0 ** 64 + 0.5 <= share)
    by_hash = Window.partitionBy("y").orderBy("_h", "_id")
    ids = stored(lab.withColumn("_at", F.row_number().over(by_hash)).where(F.col("_at") <= per_class).select("_id", "y"), "sample-ids")
    picked = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = F.broadcast(ids) if ids.count() <= MOST_IDS else ids
    return (picked.join(ids, F.col("doc_id") == F.col("_id")).groupBy("doc_id", "y").agg(F.min("text").alias("text"))
                  .select("doc_id", "text", "y"))


def by_size(items: list, limit: int = 1 << 19):
    """Consecutive slices of ``items`` (byte strings) of about ``limit`` bytes."""
    start = size = 0
    for i, x in enumerate(items):
        if i > start and size + len(x) > limit:
            yield start, i
            start, size = i, 0
        size += len(x)
    if start < len(items):
        yield start, len(items)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """A string column as byte strings, NULL as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix constants)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        a = np.full(max(n, 2 * BLOCK), base, dtype=np.uint64)
        a[0] = 1
        have = _powers[kind] = np.cumprod(a, dtype=np.uint64)
    return have


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def hash_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges of one buffer."""
    n = len(buf)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[buf] * _power("up", n)[:n], out=total[1:])
    h = (total[ends] - total[starts]) * _power("down", n)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def _blocks(data: bytes, separators: np.ndarray):
    """Pieces of ``data`` of about BLOCK bytes that end at a separator."""
    n, at = len(data), 0
    while at < n:
        end = at + BLOCK
        while end < n and not separators[data[end]]:
            end += 1
        yield data[at:min(end, n)]
        at = end


def word_hashes(data: bytes, separators: np.ndarray = SPACES) -> np.ndarray:
    """Hash of every word (maximal run of non-separator bytes), in order."""
    out = []
    for piece in _blocks(data, separators):
        buf = np.frombuffer(piece, np.uint8)
        s, e = runs(~separators[buf])
        if len(s) == 1 and e[0] - s[0] > BLOCK:  # one word longer than a block
            out.append(np.array([xxhash.xxh64_intdigest(piece[s[0]:e[0]])], np.uint64))
        elif len(s):
            out.append(hash_runs(buf, s, e))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` consecutive words (empty if fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix(h * _U(0x9E3779B97F4A7C15) + words[i:i + n])
    return h


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; a shorter text is one shingle, no word none."""
    if 0 < len(words) < k:
        return windows(words, len(words))
    return np.unique(windows(words, k))
