"""Dense, gap-free numbering over a global order, computed in parallel.

``row_number() OVER (ORDER BY ...)`` without ``PARTITION BY`` moves every row
into one task.  Here the rows are range-partitioned on the order key instead
(the range bounds come from a sample, so a hot value is still split by the
later order columns), each range is sorted locally and tagged with its
position, and the only thing aggregated is one count per range partition: a
table whose size is bounded by the number of partitions, never by the data.
That table is broadcast to turn (partition, position) into the global number.
The number of range partitions follows a row count of the input
(``session.range_partitions``), so partitions stay task-sized at any scale.

The tagged rows are written to the shared scratch folder before the counts
are taken, so a retried task can never renumber rows differently from the
counts it is combined with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import range_partitions, scratch_freed, scratch_path

_POS_BITS = 33  # monotonically_increasing_id(): partition index << 33 | position


def with_global_index(df: DataFrame, order_cols: list, name: str, start: int | Column = 1,
                      num_partitions: int | None = None, rows_hint: int | None = None,
                      keep: list[str] | None = None, staged: str | None = None, passes: int = 1) -> DataFrame:
    """Add column ``name`` = start-based dense rank of each row under ``order_cols``.

    ``order_cols`` must form a total order over the rows (ties would be
    numbered arbitrarily, as with ``row_number``).  ``start`` may be a literal
    or a one-row-per-plan scalar expression such as ``max(id) + 1``.
    ``rows_hint`` (an upper bound of the row count) sizes the range
    partitions; without it the input is counted first, so callers with an
    expensive input pass the bound they know.  ``keep`` names the columns to
    keep beside ``name`` (default: all); the others order the rows and are not
    written.  ``staged`` names a column of an input that itself shuffles much: it is written
    first, in ``passes`` parts by that column's hash, so that its shuffles and the one of the
    numbering are never on disk together.
    """
    spark = df.sparkSession
    # range partitions cannot be split later by AQE: size them by a row count
    n = num_partitions or range_partitions(spark, df.count() if rows_hint is None else rows_hint)
    path = scratch_path(spark, f"index-{name}")
    with scratch_freed(spark):
        if staged is not None:
            df = _staged(df, staged, passes, f"stage-{name}")
        (df.repartitionByRange(n, *order_cols)
           .sortWithinPartitions(*order_cols)
           .select(*(df.columns if keep is None else keep), F.monotonically_increasing_id().alias("_tb_mid"))
           .write.mode("overwrite").option("compression", "zstd").parquet(path))
    tagged = spark.read.parquet(path)
    part = F.shiftright("_tb_mid", _POS_BITS)
    counts = tagged.groupBy(part.alias("_tb_p")).agg(F.count(F.lit(1)).alias("_tb_c"))
    # one row per range partition: a single-task window over it is bounded
    before = Window.orderBy("_tb_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tb_p", F.coalesce(F.sum("_tb_c").over(before), F.lit(0)).alias("_tb_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    pos = F.col("_tb_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    out = (tagged.join(F.broadcast(offsets), part == F.col("_tb_p"))
                 .withColumn(name, (F.col("_tb_off") + pos + start_col).cast("bigint"))
                 .drop("_tb_mid", "_tb_p", "_tb_off"))
    return out


def _staged(df: DataFrame, by: str, passes: int, label: str) -> DataFrame:
    """``df`` written to the scratch folder, a part of the values of ``by`` at a time."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    part = F.pmod(F.xxhash64(by), F.lit(passes))            # a null has a hash too
    for i in range(passes):
        (df if passes == 1 else df.where(part == i)).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
