"""MERGE without a MERGE-capable table format.

``upsert`` is the single helper behind all seven MERGE statements of the
reference: a full outer join on the keys, with a presence flag per side so
that a NULL value in the source really overwrites (a ``coalesce`` on values
would silently keep the old one).  One shuffle on the keys; both sides are
hash-partitioned on them and AQE splits a skewed key range.

``write_upsert`` applies the merge to a partitioned Parquet table (by day or month):
only partitions that the source touches are read and merged.  The merged
partitions are first written, complete, to a hidden folder of the table
(``_stage-...``, marked by Spark's ``_SUCCESS``), and then take their places
one by one, each by renaming.  A job that dies before the mark leaves the table
as it was; one that dies later leaves some partitions to be put in place, and
``recover`` (the first step of every ``write_upsert``) does that.  So after a
crash the table is old or new, never a mixture, once it is opened by a writer
or by ``recover``; every single partition is whole at any time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import folders, path_exists

_S = "_tb_src_"


def dedupe_latest(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep one row per key: the last under ``order_cols`` (e.g. newest load_ts).

    An aggregate (``max_by`` over a struct of the other columns), not a
    window: it combines partially before the shuffle, so a key with many
    duplicate rows costs one row per map task."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_tb_row"))
    return picked.select(*keys, *[F.col("_tb_row." + c).alias(c) for c in rest]).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
           insert: bool = True) -> DataFrame:
    """MERGE INTO target USING source ON keys
    WHEN MATCHED THEN UPDATE SET update_cols (default: every non-key source column)
    WHEN NOT MATCHED THEN INSERT (when ``insert``).

    Rows with a NULL key never match (SQL ``=``), as in the reference.
    The result has the target's columns in the target's order.
    """
    tcols = target.columns
    scols = [c for c in source.columns if c not in keys]
    if update_cols is None:
        update_cols = [c for c in scols if c in tcols]
    src = source.select(*[F.col(c) for c in keys], *[F.col(c).alias(_S + c) for c in scols],
                        F.lit(True).alias("_tb_s"))
    tgt = target.withColumn("_tb_t", F.lit(True))
    j = tgt.join(src, keys, "full")
    in_t, in_s = F.col("_tb_t").isNotNull(), F.col("_tb_s").isNotNull()
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
            continue
        from_src = F.col(_S + c) if c in scols else F.lit(None).cast(target.schema[c].dataType)
        if c in update_cols:
            out.append(F.when(in_s, from_src).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(in_t, F.col(c)).otherwise(from_src).alias(c))
    merged = j.select(*out, in_t.alias("_tb_in_t"))
    if not insert:
        merged = merged.filter("_tb_in_t")
    return merged.drop("_tb_in_t")


_STAGE = "_stage-"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path class) of ``path``."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), cls


def _swap(spark: SparkSession, table_path: str, stage: str, partition: str) -> None:
    """Put one staged partition in its place; what was there goes below the stage folder."""
    fs, path = _hadoop(spark, table_path)
    here, there = path(f"{table_path}/{partition}"), path(f"{table_path}/{stage}/{partition}")
    old = path(f"{table_path}/{stage}/_old/{partition}")
    if fs.exists(here):
        fs.mkdirs(old.getParent())
        if not fs.rename(here, old):
            raise OSError(f"cannot rename {here}")
    if not fs.rename(there, here):
        raise OSError(f"cannot rename {there}")


def recover(spark: SparkSession, table_path: str) -> int:
    """Finish or undo what a writer that died has left; returns the number of partitions put in place."""
    done = 0
    fs, path = _hadoop(spark, table_path)
    for stage in (f for f in folders(spark, table_path) if f.startswith(_STAGE)):
        if path_exists(spark, f"{table_path}/{stage}/_SUCCESS"):
            for partition in (f for f in folders(spark, f"{table_path}/{stage}") if "=" in f):
                _swap(spark, table_path, stage, partition)
                done += 1
        fs.delete(path(f"{table_path}/{stage}"), True)
    return done


def _current(spark: SparkSession, table_path: str, like: DataFrame) -> DataFrame:
    """The table, or an empty one of the source's columns if it has no partitions yet."""
    if any("=" in f for f in folders(spark, table_path)):
        return spark.read.parquet(table_path)
    return spark.createDataFrame([], like.schema)


def write_upsert(spark: SparkSession, table_path: str, source: DataFrame, keys: list[str],
                 partition_col: str, update_cols: list[str] | None = None) -> None:
    """Merge ``source`` into the Parquet table at ``table_path`` (partitioned by
    ``partition_col``; made if it is not there), reading and rewriting only the partitions present in the source.

    The touched partition values (bounded by the calendar) become literals of
    the scan's partition filter.  Two source rows with one key are an error,
    as in a MERGE.  One writer at a time."""
    recover(spark, table_path)
    target = _current(spark, table_path, source)
    source = source.select(*target.columns)
    rows = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(partition_col).alias("p"))
    stats = rows.groupBy("p").agg(F.max("n").alias("n")).collect()
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    if any(r.n > 1 for r in stats) and not rows.filter(known & (F.col("n") > 1)).isEmpty():
        raise ValueError(f"several source rows for one key {keys}")
    touched = [r.p for r in stats if r.p is not None]
    affected = target.filter(F.col(partition_col).isin(touched) if touched else F.lit(False))
    merged = upsert(affected, source, keys, update_cols)
    merged.write.partitionBy(partition_col).parquet(f"{table_path}/{_STAGE}{uuid.uuid4().hex}")
    recover(spark, table_path)
