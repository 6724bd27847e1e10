"""Running sums per key that stay parallel when one key holds most rows.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task; a symbol with a third of all ticks or orders becomes a third of the
job in a single task.  ``running_sums`` instead:

1. range-partitions the rows on (key, order) - the bounds come from a sample,
   so a hot key is cut into many contiguous slices - and writes them, with
   their slice number, to the shared scratch folder (a retried task can then
   never see a different slicing than the offsets computed below);
2. computes running sums inside each (slice, key) with an ordinary window -
   hash-partitioned on (slice, key), so the hot key is spread over tasks;
3. adds, per (slice, key), the totals of the same key in earlier slices.
   Only the first key of a slice can continue an earlier slice, so that
   offset table has at most one row per slice: its size is bounded by the
   partition count, and it is broadcast.

The sliced plan costs a write and a second shuffle, which only pays off when
a key is too big for one task.  So the plan is chosen by measurement: one
partial aggregate counts rows per key (a scan of the key columns) and the
largest count is compared with ``tickbook.scan.maxKeyRows`` (default
4,000,000).  Below it, the plain per-key window runs (one hash shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import range_partitions, scratch_freed, scratch_path

MAX_KEY_ROWS_CONF = "tickbook.scan.maxKeyRows"
DEFAULT_MAX_KEY_ROWS = 4_000_000


def key_row_limit(spark) -> int:
    return int(spark.conf.get(MAX_KEY_ROWS_CONF, str(DEFAULT_MAX_KEY_ROWS)))


def key_stats(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows of the most frequent key, all rows) in one partial aggregation."""
    r = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return int(r[0] or 0), int(r[1] or 0)


def largest_key(df: DataFrame, keys: list[str]) -> int:
    """Rows of the most frequent key (0 for an empty input): one scalar."""
    return key_stats(df, keys)[0]


def running_sums(df: DataFrame, keys: list[str], order: list, sums: dict[str, Column],
                 num_partitions: int | None = None, label: str = "scan", materialize: bool = False,
                 sliced: bool | None = None) -> DataFrame:
    """``df`` plus one column per entry of ``sums``: the inclusive running sum
    of that expression per ``keys`` in ``order`` (which must be a total order
    within a key).  Equivalent to ``sum(e) OVER (PARTITION BY keys ORDER BY order
    ROWS UNBOUNDED PRECEDING)``.  With ``materialize`` the result is written to
    the scratch folder too, for callers that read it more than once.
    ``sliced`` forces the plan (None: measure, see the module doc)."""
    spark = df.sparkSession
    if materialize:
        done = scratch_path(spark, label + "-out")
        with scratch_freed(spark):
            (running_sums(df, keys, order, sums, num_partitions, label, sliced=sliced)
                .write.mode("overwrite").option("compression", "zstd").parquet(done))
        return spark.read.parquet(done)
    names = list(sums)
    vals = [f"_tb_v{i}" for i in range(len(names))]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    total = None
    if sliced is None:
        hot, total = key_stats(df, keys)
        sliced = hot > key_row_limit(spark)
    if not sliced:
        w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(e).over(w).alias(name) for name, e in sums.items()])
    n = num_partitions or range_partitions(spark, df.count() if total is None else total)
    parts = _slices(df.select("*", *[e.alias(v) for v, e in zip(vals, sums.values())]), keys, order_cols, n, label)

    local_w = Window.partitionBy("_tb_slice", *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("*", *[F.sum(v).over(local_w).alias(v + "_l") for v in vals])

    totals = parts.groupBy("_tb_slice", *keys).agg(*[F.sum(v).alias(v + "_t") for v in vals])
    earlier = Window.partitionBy(*keys).orderBy("_tb_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select("_tb_slice", *keys, *[F.sum(v + "_t").over(earlier).alias(v + "_o") for v in vals])
                     .where(F.col(vals[0] + "_o").isNotNull()))

    out = local.join(F.broadcast(offsets), ["_tb_slice", *keys], "left")
    return out.select(*df.columns,
                      *[(F.coalesce(F.col(v + "_o"), F.lit(0)) + F.col(v + "_l")).alias(name)
                        for name, v in zip(names, vals)])


def running_last(df: DataFrame, keys: list[str], order: list, lasts: dict[str, Column], num_partitions: int,
                 label: str = "scan", sliced: bool = False) -> DataFrame:
    """``df`` plus one column per entry of ``lasts``: the last value of that expression, up to the row,
    that is not null, per ``keys`` in ``order``.  With ``sliced`` as ``running_sums`` does it: a
    slice adds what the earlier slices of its first key ended with."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if not sliced:
        w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.last(e, ignorenulls=True).over(w).alias(name) for name, e in lasts.items()])
    names = list(lasts)
    vals = [f"_tb_v{i}" for i in range(len(names))]
    parts = _slices(df.select("*", *[e.alias(v) for v, e in zip(vals, lasts.values())]), keys, order_cols, num_partitions, label)
    local_w = Window.partitionBy("_tb_slice", *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("*", *[F.last(v, ignorenulls=True).over(local_w).alias(v + "_l") for v in vals])

    ends = parts.groupBy("_tb_slice", *keys).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order_cols))).alias(v + "_t") for v in vals])
    earlier = Window.partitionBy(*keys).orderBy("_tb_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (ends.select("_tb_slice", *keys, *[F.last(v + "_t", ignorenulls=True).over(earlier).alias(v + "_o") for v in vals])
                  .where(" OR ".join(f"{v}_o IS NOT NULL" for v in vals)))
    out = local.join(F.broadcast(before), ["_tb_slice", *keys], "left")
    return out.select(*df.columns, *[F.coalesce(v + "_l", v + "_o").alias(name) for name, v in zip(names, vals)])


def _slices(df: DataFrame, keys: list[str], order_cols: list, n: int, label: str) -> DataFrame:
    """``df`` cut into ``n`` ranges of (keys, order) with their number ``_tb_slice``, in the scratch folder."""
    path = scratch_path(df.sparkSession, label)
    with scratch_freed(df.sparkSession):
        (df.repartitionByRange(n, *keys, *order_cols)
           .withColumn("_tb_slice", F.spark_partition_id())
           .write.mode("overwrite").option("compression", "zstd").parquet(path))
    return df.sparkSession.read.parquet(path)
