"""What the queries leave on disk, and that a step's files go when the next has them."""

import contextlib
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickbook.functions.ids import with_global_index
from tickbook.operators import matching
from tickbook.operators.matching_rules import CELL_ROWS_CONF
from tickbook.functions.scan import MAX_KEY_ROWS_CONF
from tickbook.plans import registry
from tickbook.session import checkpoint_root, path_exists, scratch_freed, scratch_kept, scratch_path
from tickbook.sources import fixtures as fx

from .conftest import SF001
from .test_fixtures import _tables
from .test_streaming import _auctions


def _folders(spark):
    return set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/tickbook/*"))


@contextlib.contextmanager
def left_behind(spark):
    """Labels of the folders that are there at the end and were not at the start, with their number."""
    before, left = _folders(spark), Counter()
    yield left
    left.update(os.path.basename(p).rsplit("-", 1)[0] for p in _folders(spark) - before)


@contextlib.contextmanager
def conf(spark, key, value):
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


@pytest.fixture
def sf(tmp_path):
    """The small tables at a path of their own: the lines are numbered anew."""
    os.symlink(SF001, tmp_path / "tables")
    return str(tmp_path / "tables")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_scratch_of_a_block_is_deleted_but_for_what_is_kept(spark):
    def table(label):
        path = scratch_path(spark, label)
        spark.range(3).write.parquet(path)
        return path
    with scratch_freed(spark):
        with scratch_freed(spark, keep="b"):
            a, b = table("a"), table("b")
        assert not path_exists(spark, a) and path_exists(spark, b)
        with scratch_kept():
            c = table("c")
        with pytest.raises(ValueError), scratch_freed(spark):
            d = table("d")
            raise ValueError
    assert [path_exists(spark, p) for p in (a, b, c, d)] == [False, False, True, False]
    assert spark.read.parquet(c).count() == 3
    e = table("e")
    assert path_exists(spark, e)


def test_shuffles_of_a_block_are_removed(spark):
    def shuffled():
        tmp = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(tmp.apply(i).getName().startswith("shuffle_") and tmp.apply(i).getName().endswith(".data") for i in range(tmp.size()))
    wide = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count()
    before = shuffled()
    with scratch_freed(spark):
        wide.write.parquet(scratch_path(spark, "grouped"))
    assert shuffled() <= before


@pytest.mark.parametrize("passes", [1, 2, 5])
def test_staged_rows_are_numbered_as_others(spark, passes):
    rows = [(i, None if i % 7 == 0 else i % 5, f"t{i}") for i in range(200)]
    d = spark.createDataFrame(rows, "v long, k long, t string")
    with left_behind(spark) as left:
        got = with_global_index(d, ["v"], "ix", staged="k", passes=passes)
        assert sorted((r.ix, r.v, r.k, r.t) for r in got.collect()) == [(v + 1, v, k, t) for v, k, t in rows]
    assert left == {"index-ix": 1}


def test_lines_in_passes_are_the_same(spark, monkeypatch):
    path, joined = _tables(spark)
    monkeypatch.setattr(fx, "LINES_PER_PASS", 1)
    seen = []
    number = fx.with_global_index
    monkeypatch.setattr(fx, "with_global_index", lambda *a, **k: (seen.append(k["passes"]), number(*a, **k))[1])
    with left_behind(spark) as left, scratch_freed(spark):
        got = fx.lines(spark, path).collect()
    day = lambda r: (r[10], r[0], r[3], r[1], r[2] is not None, r[2] or 0, r[4], r[5])
    assert [(r.l_shipdate, r.l_extendedprice) for r in sorted(got, key=lambda r: r.n)] == [(r[10], r[5]) for r in sorted(joined, key=day)]
    assert seen == [fx.MAX_PASSES] and left == {"fixture-lines": 1}


@pytest.mark.parametrize("most", [None, 2000])
def test_auctions_of_many_deliveries(spark, sf, monkeypatch, most):
    """Deliveries cut by time, and files that come one at a time: every order is matched, and the
    messages that were read are gone."""
    from tickbook.streaming import sources
    monkeypatch.setattr(sources, "TRIGGER_BYTES", 1)
    if most:
        monkeypatch.setattr(registry, "MESSAGES_PER_DELIVERY", most)
    cols = ["order_id", "customer_id", "symbol", "side", "price", "created_at", "quantity"]
    rows = [tuple(r) for r in fx.book(spark, SF001).select(*cols).collect()]
    with left_behind(spark) as left:
        got = registry.QUERIES["stream_match_intervals"](spark, sf)
        got = sorted((r.buy_order_id, r.sell_order_id, r.quantity, r.trade_price) for r in got.collect())
    assert got == _auctions(rows, registry.AUCTION_INTERVAL.days)
    assert not _folders_with_files(spark, "order-messages") and not {"index-n", "stage-n"} & set(left)


def _folders_with_files(spark, label):
    return [p for p in _folders(spark) if os.path.basename(p).startswith(label) and glob.glob(p + "/*/*.parquet")]


def test_deliveries_hold_every_message_in_time_order(spark, monkeypatch):
    monkeypatch.setattr(registry, "MESSAGES_PER_DELIVERY", 10)
    rows = [(i, None if i % 11 == 0 else f"2024-01-{1 + i % 25:02d} 00:00:00") for i in range(120)]
    m = spark.createDataFrame(rows, "i long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    parts = [sorted((r.t, r.i) for r in p.collect()) for p in registry._deliveries(m, "t")]
    timed = sorted((r.t, r.i) for r in m.where("t IS NOT NULL").collect())
    second = next(k for k in range(1, len(parts)) if parts[k] == parts[0])
    assert second > 1 and parts[:second] == parts[second:2 * second]
    assert sum(parts[second:], []) == timed and max(map(len, parts)) < 30
    assert len(registry._deliveries(m.where("t IS NULL"), "t")) == 3


@pytest.mark.parametrize("limit", [None, "100"])
def test_order_flow_leaves_its_tables_only(spark, sf, limit):
    def run(path):
        return _rows(registry.QUERIES["order_flow_two_runs"](spark, path))
    with left_behind(spark) as left, conf(spark, MAX_KEY_ROWS_CONF, limit or "4000000"):
        got = run(sf)
    assert left == {"fixture-lines": 1, "topics": 1, "dispatched": 1, "orders": 1, "holdings": 1, "trades": 2, "events": 4, "rejects": 2}
    assert len(got) > 1000 and len({r.split(",")[0] for r in got}) == len(got)
    if limit:
        assert got == run(SF001)


@pytest.mark.parametrize("limit", ["100", "1000000"])
def test_time_rule_leaves_its_numbered_trades_only(spark, sf, limit):
    with left_behind(spark) as left, conf(spark, CELL_ROWS_CONF, limit):
        got = registry.QUERIES["match_time_rule"](spark, sf)
        rows = _rows(got)
    assert left == {"fixture-lines": 1, "index-trade_id": 1}
    assert rows == _rows(registry.QUERIES["match_time_rule"](spark, SF001)) and len(rows) > 100


def test_a_sliced_sweep_leaves_its_pairs_only(spark):
    book = fx.book(spark, SF001)
    want = _rows(matching.match_price_time(book))
    with left_behind(spark) as left, conf(spark, MAX_KEY_ROWS_CONF, "50"):
        got = _rows(matching.match_price_time(book))
    assert got == want and left == {"book-scan-out": 1, "index-trade_id": 1}
