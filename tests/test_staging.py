import datetime as dt
import os
import tempfile

import pytest

from tickbook.operators.staging import cleanse, load_staging
from tickbook.sources.price_files import read_price_files

HEADER = "date,Symbol,open,high,low,close,adj_close,volume\n"


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_cleanse_bad_number_empty_volume_empty_close(spark):
    d = tempfile.mkdtemp(prefix="tb-csv-")
    _write(d, "AAA.csv", HEADER +
           "2024-01-02,AAA,abc,2,1,1.5,1.5,100\n"
           "2024-01-03,AAA,1,2,1,1.5,1.5,\n"
           "2024-01-04,AAA,1,2,1,,1.5,7\n"
           "2024-01-05,,1,2,1,1.5,1.5,7\n"
           "2024-01-08,AAA,1,2,1,NaN,1.5,7.9\n")
    staged, rejects = cleanse(read_price_files(spark, d))
    s = [(r.symbol, str(r.trade_date), r.volume) for r in staged.collect()]
    assert s == [("AAA", "2024-01-03", 0)]
    rj = sorted((str(r.trade_date), r.reason) for r in rejects.collect())
    assert rj == [("2024-01-02", "open_price"), ("2024-01-04", "close_price"),
                  ("2024-01-05", "symbol"), ("2024-01-08", "close_price")]


def test_volume_truncates(spark):
    d = tempfile.mkdtemp(prefix="tb-csv-")
    _write(d, "B.csv", HEADER + "2024-01-02,B,1,2,1,1.5,1.5,7.9\n")
    staged, _ = cleanse(read_price_files(spark, d))
    assert staged.first().volume == 7


def test_missing_column_fails_and_keeps_staging(spark):
    d = tempfile.mkdtemp(prefix="tb-csv-")
    _write(d, "GOOD.csv", HEADER + "2024-01-02,GOOD,1,2,1,1.5,1.5,1\n")
    table = os.path.join(tempfile.mkdtemp(prefix="tb-stg-"), "stg")
    load_staging(spark, read_price_files(spark, d), table, load_ts="2024-01-01 00:00:00")
    before = sorted(tuple(r) for r in spark.read.parquet(table).collect())
    _write(d, "BAD.csv", "date,Symbol,open,high,low,close,volume\n2024-01-02,BAD,1,2,1,1.5,1\n")
    with pytest.raises(Exception):
        load_staging(spark, read_price_files(spark, d), table + "-next", load_ts="2024-01-01 00:00:00")
    assert sorted(tuple(r) for r in spark.read.parquet(table).collect()) == before


def test_columns_in_any_order_and_extra_columns(spark):
    d = tempfile.mkdtemp(prefix="tb-csv-")
    _write(d, "A.csv", HEADER + "2024-01-02,A,1,2,0.5,1.5,1.5,10\n")
    _write(d, "B.csv", "volume,extra,Symbol,date,adj_close,close,low,high,open\n"
                       "20,x,B,2024-01-03,2.5,2.5,1.5,3,2\n")
    staged, rejects = cleanse(read_price_files(spark, d))
    got = sorted((r.symbol, str(r.trade_date), r.open_price, r.high_price, r.low_price, r.close_price, r.volume)
                 for r in staged.collect())
    assert got == [("A", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10), ("B", "2024-01-03", 2.0, 3.0, 1.5, 2.5, 20)]
    assert rejects.count() == 0


def _one_day(spark, files):
    from tickbook.operators import star
    from tickbook.operators.staging import load_price_files
    d = tempfile.mkdtemp(prefix="tb-csv-")
    for name, text in files.items():
        _write(d, name, text)
    staged = spark.read.parquet(load_price_files(spark, d, load_ts="2024-01-01 00:00:00")[0])
    ds, dd = star.load_dim_symbol(staged), star.load_dim_date(staged)
    return [(r.close_price, r.volume) for r in star.load_fact_daily(staged, ds, dd).collect()]


def test_of_duplicate_rows_the_last_line_of_the_last_file_wins(spark):
    lines = [f"2024-01-02,A,1,2,0.5,{i}.5,1.5,{i}\n" for i in range(1, 9)]
    assert _one_day(spark, {"a.csv": HEADER + "".join(lines[:4]), "b.csv": HEADER + "".join(lines[4:])}) == [(8.5, 8)]
    assert _one_day(spark, {"a.csv": HEADER + "".join(lines[4:]), "b.csv": HEADER + "".join(lines[3::-1])}) == [(1.5, 1)]
    # with a file of another layout the rows are read by their places
    assert _one_day(spark, {"a.csv": HEADER + lines[6], "b.csv": "volume," + HEADER.replace(",volume", "") + "5,2024-01-02,A,1,2,0.5,3.5,1.5\n"
                            }) == [(3.5, 5)]


def test_load_replaces_a_table_only_after_success(spark):
    from tickbook.operators.staging import load_price_files
    d, table = tempfile.mkdtemp(prefix="tb-csv-"), os.path.join(tempfile.mkdtemp(prefix="tb-stg-"), "stg")
    for i in (1, 2, 3):
        _write(d, "A.csv", HEADER + f"2024-01-02 09:30:00,A,1,2,1,1.5,1.5,{i}\n2024-01-03,A,x,2,1,1.5,1.5,{i}\n")
        staged, rejects = load_price_files(spark, d, table)
        assert staged == table
        assert [(str(r.trade_date), r.volume) for r in spark.read.parquet(table).collect()] == [("2024-01-02", i)]
        assert [r.reason for r in spark.read.parquet(rejects).collect()] == ["open_price"]
    _write(d, "B.csv", "date,Symbol,open\n2024-01-02,B,1\n")
    with pytest.raises(ValueError, match="lack columns"):
        load_price_files(spark, d, table)
    assert [r.volume for r in spark.read.parquet(table).collect()] == [3]


def test_monthly_average_keeps_small_prices(spark):
    from tickbook.operators import star
    rows = spark.createDataFrame([("A", dt.date(2024, 1, d), .004, .004, .004, .004, .004, 1) for d in (2, 3)],
                                 "symbol string, trade_date date, open_price double, high_price double, low_price double, "
                                 "close_price double, adj_close double, volume long")
    ids = spark.createDataFrame([("A", 1)], "symbol string, symbol_id long")
    assert star.monthly_rows(rows, ids).first().avg_close == pytest.approx(.004)
