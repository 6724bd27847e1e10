"""Fact tables bucketed by their merge keys.

A MERGE into a plain Parquet table shuffles the whole table to meet the batch.
A table saved in buckets of its keys lies as that shuffle would leave it: the
join reads it bucket by bucket, with no exchange (and no sort: buckets are
sorted) on its side, and only the batch is shuffled, whatever the size of the
table.  The joined rows are in the buckets' order again, so the new table is
written without a shuffle, too.

A table is a catalog table over a folder of versions.  ``merge`` writes the
next version beside the current one and then moves the table's location, one
change in the catalog: a reader sees the old table or the new one, and a job
that dies before leaves the old one.  An earlier version stays on disk until
``drop_versions``.  The catalog may forget a table (in-memory catalogs do at
the end of a session); ``attach`` declares it again from its folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import folders
from .upsert import upsert


def _names(cols: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in cols)


def attach(spark: SparkSession, table: str, location: str, ddl: str, keys: list[str], buckets: int) -> DataFrame:
    """Declare the table over the version at ``location``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY ({_names(keys)}) "
              f"SORTED BY ({_names(keys)}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(table)


def _save(df: DataFrame, location: str, keys: list[str], buckets: int) -> None:
    """Write a version: one pass, every task its own buckets, sorted by the keys."""
    name = f"version_{uuid.uuid4().hex}"
    spark = df.sparkSession
    (df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")                               # an external table: the files stay


def _version(folder: str) -> str:
    return os.path.join(folder, f"v-{uuid.uuid4().hex}")


def create(spark: SparkSession, table: str, folder: str, rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """A new table of ``rows`` (one row a key) below ``folder``."""
    location = _version(folder)
    _save(rows.repartition(buckets, *keys), location, keys, buckets)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return attach(spark, table, location, ddl, keys, buckets)


def _spec(spark: SparkSession, table: str) -> tuple[list[str], int, str]:
    """(bucket columns, number of buckets, location) from the catalog."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")]
    return keys, int(rows["Num Buckets"]), rows["Location"]


def merged(spark: SparkSession, table: str, source: DataFrame, update_cols: list[str] | None = None,
           insert: bool = True) -> DataFrame:
    """The table after MERGE with ``source`` on its bucket columns, not written yet."""
    keys, buckets, _ = _spec(spark, table)
    # as many partitions as buckets, by the same hash: the join then leaves the table where it is
    return upsert(spark.table(table), source.repartition(buckets, *keys), keys, update_cols, insert)


def merge(spark: SparkSession, table: str, source: DataFrame, update_cols: list[str] | None = None,
          insert: bool = True) -> None:
    """MERGE ``source`` into the table.  Two source rows with one key are an error."""
    keys, buckets, location = _spec(spark, table)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    if not source.where(known).groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"several source rows for one key {keys}")
    new = _version(os.path.dirname(location.rstrip("/")))
    _save(merged(spark, table, source, update_cols, insert), new, keys, buckets)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)


def drop_versions(spark: SparkSession, table: str) -> int:
    """Delete the versions that are not current; returns how many."""
    location = _spec(spark, table)[2].rstrip("/")
    folder, current = os.path.split(location)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [f for f in folders(spark, folder) if f.startswith("v-") and f != current]
    for f in old:
        fs.delete(path(os.path.join(folder, f)), True)
    return len(old)
