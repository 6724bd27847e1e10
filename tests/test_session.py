from tickbook.session import (ROCKSDB, checkpoint_root, range_partitions, rocksdb_state, scale_conf,
                              scratch_path)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_scale_conf_sizes_by_input():
    c = scale_conf(100 * 10**12)
    assert int(c["spark.sql.shuffle.partitions"]) > 300_000
    assert scale_conf(10**6)["spark.sql.shuffle.partitions"] == "200"


def test_range_partitions_never_below_shuffle_partitions(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(spark, 0) == base
    assert range_partitions(spark, 10**10) == 2500


def test_rocksdb_state_restores_the_session_value(spark):
    before = spark.conf.get(PROVIDER, None)
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(PROVIDER, hdfs)
    try:
        with rocksdb_state(spark):
            assert spark.conf.get(PROVIDER) == ROCKSDB
        assert spark.conf.get(PROVIDER) == hdfs
    finally:
        spark.conf.set(PROVIDER, before or ROCKSDB)


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
