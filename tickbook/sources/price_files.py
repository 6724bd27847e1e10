"""Price CSV files: per-symbol export (S4) and the staging scan (S1, S2).

File layout: one folder per symbol below the export root
(``symbol_hex=<hex of the symbol>/part-*.csv``: symbols such as ``Brand#7``
contain characters that are escaped in folder names), each file with the header
``date,Symbol,open,high,low,close,adj_close,volume``.  A symbol's folder
holds one or more part files (a large symbol is written by several tasks and
capped by ``maxRecordsPerFile``) instead of one huge file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's CSV header.
CSV_COLUMNS = ["date", "Symbol", "open", "high", "low", "close", "adj_close", "volume"]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])
MAX_RECORDS_PER_FILE = 5_000_000
FOLDER_COL = "symbol_hex"


def export_price_files(prices: DataFrame, out_dir: str) -> None:
    """Write one CSV folder per symbol with the reference's columns and order."""
    rows = prices.select(
        F.date_format("price_date", "yyyy-MM-dd").alias("date"),
        F.col("symbol").alias("Symbol"),
        F.col("open_price").cast("string").alias("open"),
        F.col("high_price").cast("string").alias("high"),
        F.col("low_price").cast("string").alias("low"),
        F.col("close_price").cast("string").alias("close"),
        F.col("adj_close").cast("string").alias("adj_close"),
        F.col("volume").cast("string").alias("volume"),
    ) if "price_date" in prices.columns else prices.select(*CSV_COLUMNS)
    # range-partitioned on (symbol, date): a symbol's rows arrive in few
    # tasks, contiguous in time, and a hot symbol is split over many writers
    (rows.withColumn(FOLDER_COL, F.hex(F.col("Symbol")))
         .repartitionByRange(F.col(FOLDER_COL), F.col("date"))
         .write.mode("overwrite")
         .option("header", True)
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
         .partitionBy(FOLDER_COL)
         .csv(out_dir))


# where a row stood in its input; sorts as (file, offset of the block, line in the block)
POSITION_COLS = ["source_file", "file_block", "file_row"]
HEADER_ERROR = "CSV header"      # start of the reader's message when a header is not the expected one


def _with_position(rows: DataFrame, columns: list) -> DataFrame:
    return rows.select(*columns, F.col("_metadata.file_path").alias("source_file"),
                       F.col("_metadata.file_block_start").alias("file_block"),
                       F.monotonically_increasing_id().alias("file_row"))


def _csv(spark: SparkSession):
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv"))


def read_standard_files(spark: SparkSession, in_dir: str) -> DataFrame:
    """All ``*.csv`` below ``in_dir`` in one read: the reader itself compares each
    file's header with the standard one, and a differing file fails the job that
    uses the rows (``is_header_error`` tells this failure from others)."""
    return _with_position(_csv(spark).option("enforceSchema", False).schema(RAW_SCHEMA).csv(in_dir), CSV_COLUMNS)


def is_header_error(e: Exception) -> bool:
    return HEADER_ERROR in str(e)


def file_headers(spark: SparkSession, in_dir: str) -> DataFrame:
    """(source_file, header) of every ``*.csv`` below ``in_dir``: a scan of its own."""
    t = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(in_dir)
              .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("blk"),
                      "value", F.monotonically_increasing_id().alias("pos")))
    return t.filter(F.col("blk") == 0).groupBy("source_file").agg(F.min_by("value", "pos").alias("header"))


def _columns(header: str) -> list[str]:
    return [c.strip().strip('"') for c in header.split(",")]


def read_price_files(spark: SparkSession, in_dir: str) -> DataFrame:
    """All ``*.csv`` below ``in_dir`` as strings (the eight expected columns),
    plus the row's place (``POSITION_COLS``).

    Like the reference's loader, a file must contain every expected column,
    in any order, extra columns ignored; a file without e.g. ``adj_close``
    fails the whole load before anything is written.  Only the distinct
    layouts come to the driver.  With several of them the files are read by
    place, and each row takes its columns by the layout of its file (a join
    on the file name, one row per file)."""
    headers = file_headers(spark, in_dir)
    layouts = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("source_file").alias("example")).collect()
    for row in layouts:
        missing = [c for c in CSV_COLUMNS if c not in _columns(row["header"])]
        if missing:
            raise ValueError(f"{row['n']} file(s) such as {row['example']} lack columns {missing}")
    if not layouts:
        places = "source_file string, file_block bigint, file_row bigint"
        return spark.createDataFrame([], T.StructType(RAW_SCHEMA.fields + T._parse_datatype_string(places).fields))
    width = max(len(_columns(row["header"])) for row in layouts)
    places = [f"_c{i}" for i in range(width)]
    raw = _csv(spark).schema(T.StructType([T.StructField(c, T.StringType(), True) for c in places])).csv(in_dir)

    def named(row):
        cols = _columns(row["header"])
        return {c: F.col(places[cols.index(c)]) for c in CSV_COLUMNS}

    rows = _with_position(raw, places)
    if len(layouts) == 1:
        return rows.select(*[v.alias(c) for c, v in named(layouts[0]).items()], *POSITION_COLS)
    rows = rows.join(headers, "source_file")
    picked = [F.coalesce(*[F.when(F.col("header") == row["header"], named(row)[c]) for row in layouts]).alias(c)
              for c in CSV_COLUMNS]
    return rows.select(*picked, *POSITION_COLS)


def read_exported(spark: SparkSession, in_dir: str) -> DataFrame:
    """Read an export back with the symbol of its folder (partition discovery)."""
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(FOLDER_COL, T.StringType(), True)])
    r = spark.read.option("header", True).schema(schema).csv(in_dir)
    return r.withColumn("file_symbol", F.decode(F.unhex(FOLDER_COL), "UTF-8")).drop(FOLDER_COL)
