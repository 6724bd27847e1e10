import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickbook.functions.scan import running_sums
from tickbook.operators.risk import risk_rolling


def test_running_sums_hot_key_split_over_slices(spark):
    rnd = random.Random(3)
    # one key holds ~90% of the rows
    rows = [("HOT" if rnd.random() < 0.9 else f"k{rnd.randint(0, 5)}", i, rnd.randint(1, 9)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = running_sums(df, ["k"], ["o"], {"s": F.col("v"), "n": F.lit(1).cast("bigint")}, num_partitions=16,
                       sliced=True)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "o", "v", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_risk_from_prefix_moments_equals_sliding_windows(spark):
    """Both scans, against the standard deviation of every window on its own."""
    import datetime as dt
    import statistics
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("HOT" if i % 5 else "B", t0 + dt.timedelta(seconds=i), i, round(1e6 * (i % 7 == 0) + 100 + rnd.gauss(0, 1), 6)) for i in range(3000)]
    ticks = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, price double")
    want = {}
    for symbol in ("HOT", "B"):
        mine = [r for r in rows if r[0] == symbol]
        for n in range(50, len(mine) + 1):
            if n >= 200 or n % 50 == 0:
                want[symbol, n] = (mine[n - 1][2], statistics.stdev([r[3] for r in mine[max(0, n - 200):n]]) * 1000)
    for sliced in (False, True):
        got = {(r.symbol, r.tick_no): (r.seq, r.risk_score) for r in risk_rolling(ticks, sliced=sliced).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) <= 1e-9 * want[k][1] for k in want)


def test_risk_of_constant_prices_is_zero(spark):
    import datetime as dt
    rows = [("A", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i, 0.1) for i in range(300)]
    ticks = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, price double")
    got = [r.risk_score for r in risk_rolling(ticks).collect()]
    assert len(got) == 3 + 101 and set(got) == {0.0}
    one = risk_rolling(ticks.limit(1), window=1, stride=1)
    assert [r.risk_score for r in one.collect()] == [0.0]


def test_matching_sliced_plan_equals_window_plan(spark):
    """Force the sliced scans (as for a hot symbol) and compare with the default plan."""
    from tickbook.functions import scan
    from tickbook.operators import matching
    from tickbook.sources import fixtures as fx
    from .conftest import SF001
    book = fx.book(spark, SF001)
    default = sorted(map(tuple, matching.match_price_time(book).collect()))
    spark.conf.set(scan.MAX_KEY_ROWS_CONF, "10")
    try:
        sliced = sorted(map(tuple, matching.match_price_time(book).collect()))
    finally:
        spark.conf.unset(scan.MAX_KEY_ROWS_CONF)
    assert sliced == default and len(default) > 0


def test_range_partitions_follow_row_count(spark):
    from tickbook.functions.ids import with_global_index
    from tickbook.session import RANGE_ROWS_CONF, range_partitions
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(RANGE_ROWS_CONF, "100")
    try:
        assert range_partitions(spark, 5000) == max(base, 50)
        d = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
        r = with_global_index(d, ["v"], "ix")
        assert r.filter(F.col("ix") != F.col("v") + 1).count() == 0
    finally:
        spark.conf.unset(RANGE_ROWS_CONF)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]), st.integers(-50, 50)),
                min_size=1, max_size=300),
       st.integers(2, 20))
def test_running_sums_sliced_equals_window_property(spark, rows, parts):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, o long, v long")
    got = running_sums(df, ["k"], ["o"], {"s": F.col("v")}, num_partitions=parts, sliced=True)
    want = running_sums(df, ["k"], ["o"], {"s": F.col("v")}, sliced=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]), st.none() | st.integers(-50, 50), st.none() | st.integers(-50, 50)),
                min_size=1, max_size=300),
       st.integers(2, 20))
def test_running_last_sliced_equals_a_loop(spark, rows, parts):
    from tickbook.functions.scan import running_last
    df = spark.createDataFrame([(k, i, x, y) for i, (k, x, y) in enumerate(rows)], "k string, o long, x long, y long")
    lasts = {"p": F.struct("x"), "q": F.col("y")}
    lasts["p"] = F.when(F.col("x").isNotNull(), lasts["p"])
    want, now = [], {}
    for i, (k, x, y) in enumerate(rows):
        p, q = now.get(k, (None, None))
        now[k] = p, q = (p if x is None else (x,), q if y is None else y)
        want.append((k, i, x, y, p, q))
    for sliced in (True, False):
        got = [(*r[:4], r.p and tuple(r.p), r.q) for r in running_last(df, ["k"], ["o"], lasts, parts, sliced=sliced).collect()]
        assert sorted(got, key=lambda r: r[1]) == want
