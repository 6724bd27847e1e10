import datetime as dt
import os
import tempfile

from tickbook.operators.upsert import upsert, write_upsert


def test_update_insert_keep_and_null_overwrites(spark):
    t = spark.createDataFrame([("A", 1, 10.0), ("B", 1, 20.0)], "sym string, d int, v double")
    s = spark.createDataFrame([("A", 1, None), ("C", 1, 30.0)], "sym string, d int, v double")
    got = sorted(tuple(r) for r in upsert(t, s, ["sym", "d"]).collect())
    assert got == [("A", 1, None), ("B", 1, 20.0), ("C", 1, 30.0)]


def test_update_cols_subset_keeps_other_columns(spark):
    t = spark.createDataFrame([("A", 1.0, "v0")], "sym string, score double, model string")
    s = spark.createDataFrame([("A", 2.0, "v1"), ("B", 3.0, "v1")], "sym string, score double, model string")
    got = sorted(tuple(r) for r in upsert(t, s, ["sym"], update_cols=["score"]).collect())
    assert got == [("A", 2.0, "v0"), ("B", 3.0, "v1")]


def test_idempotent(spark):
    t = spark.createDataFrame([("A", 1, 10.0)], "sym string, d int, v double")
    s = spark.createDataFrame([("A", 1, 11.0), ("B", 2, 5.0)], "sym string, d int, v double")
    once = upsert(t, s, ["sym", "d"])
    twice = upsert(once, s, ["sym", "d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_write_upsert_rewrites_only_touched_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tb-ups-"), "fact")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.createDataFrame([("A", d1, 1), ("A", d2, 2)], "symbol string, day date, qty long") \
        .write.partitionBy("day").parquet(path)
    untouched = sorted(os.listdir(os.path.join(path, "day=2024-01-01")))
    src = spark.createDataFrame([("A", d2, 5), ("B", d2, 7)], "symbol string, day date, qty long")
    write_upsert(spark, path, src, ["symbol", "day"], "day")
    got = sorted((r.symbol, str(r.day), r.qty) for r in spark.read.parquet(path).collect())
    assert got == [("A", "2024-01-01", 1), ("A", "2024-01-02", 5), ("B", "2024-01-02", 7)]
    assert sorted(os.listdir(os.path.join(path, "day=2024-01-01"))) == untouched


def test_dedupe_latest_keeps_newest_row_per_key(spark):
    from tickbook.operators.upsert import dedupe_latest
    rows = [("A", 1, i, float(i)) for i in range(500)] + [("B", 1, 3, 9.0), ("B", 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "sym string, d int, load_ts int, v double")
    got = sorted(tuple(r) for r in dedupe_latest(df, ["sym", "d"], ["load_ts"]).collect())
    assert got == [("A", 1, 499, 499.0), ("B", 1, 3, 9.0)]


def _months(spark, path):
    return sorted((r.k, r.v) for r in spark.read.parquet(path).collect())


def test_a_crash_between_two_partitions_is_repaired(spark, monkeypatch):
    from tickbook.operators import upsert as module
    from tickbook.session import folders, scratch_path
    path = scratch_path(spark, "crash-target")
    s = "k int, v int, m string"
    old = [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]
    new = [(1, 10, "a"), (2, 20, "b"), (4, 40, "d")]
    write_upsert(spark, path, spark.createDataFrame(old, s), ["k"], "m")                # the table is made
    swap, calls = module._swap, []

    def dies(spark, table, stage, partition):
        calls.append(partition)
        if len(calls) == 2:
            raise KeyboardInterrupt("killed")
        swap(spark, table, stage, partition)
    monkeypatch.setattr(module, "_swap", dies)
    import pytest
    with pytest.raises(KeyboardInterrupt):
        write_upsert(spark, path, spark.createDataFrame(new, s), ["k"], "m")
    monkeypatch.setattr(module, "_swap", swap)
    assert module.recover(spark, path) == 2                                             # the two partitions left
    assert _months(spark, path) == [(1, 10), (2, 20), (3, 3), (4, 40)]
    assert module.recover(spark, path) == 0 and not [f for f in folders(spark, path) if f.startswith("_")]


def test_a_crash_before_the_stage_is_complete_changes_nothing(spark):
    from tickbook.operators import upsert as module
    from tickbook.session import folders, scratch_path
    path = scratch_path(spark, "crash-target")
    s = "k int, v int, m string"
    write_upsert(spark, path, spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], s), ["k"], "m")
    half = spark.createDataFrame([(1, 9, "a")], s)
    (half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("m")
         .parquet(path + "/_stage-dead"))
    assert _months(spark, path) == [(1, 1), (2, 2)]                                      # readers do not see it
    write_upsert(spark, path, spark.createDataFrame([(2, 5, "b")], s), ["k"], "m")
    assert _months(spark, path) == [(1, 1), (2, 5)] and folders(spark, path) == ["m=a", "m=b"]


def test_a_first_batch_that_died_without_files(spark):
    from pyspark.sql import functions as F

    from tickbook.session import scratch_path
    from tickbook.streaming.bars import upsert_bars_batch
    from tickbook.operators.bars import bars
    path = scratch_path(spark, "crash-first")
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path + "/_temporary/0")
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)                            # what a killed first write leaves
    t = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 9, 30, i), i, 1.0 + i) for i in range(5)],
                              "symbol string, ts timestamp_ntz, seq bigint, price double")
    for _ in range(2):                                                                  # the replay, and one more
        upsert_bars_batch(path)(bars(t), 0)
    assert [(r.open_price, r.close_price, r.tick_count) for r in spark.read.parquet(path).collect()] == [(1.0, 5.0, 5)]
    assert spark.read.parquet(path).where(F.col("bar_day") == dt.date(2024, 1, 1)).count() == 1
