"""Procedures called from SQL."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF001
from tickbook.operators import holdings, reports, settlement
from tickbook.plans import procedures
from tickbook.session import scratch_path
from tickbook.sources import fixtures as fx


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_functions_equal_the_reports(spark):
    t, p = fx.trades(spark, SF001), fx.prices(spark, SF001)
    procedures.install(spark, t, p)
    h = holdings.holdings(t)
    some = h.agg(F.max("customer_id")).first()[0]
    assert rows(spark.sql("SELECT * FROM customer_pnl(:c)", args={"c": some})) == rows(reports.customer_pnl(spark, h, p, some))
    day = t.agg(F.max(F.to_date("trade_time"))).first()[0]
    assert rows(spark.sql("SELECT * FROM top_traded(:d)", args={"d": day})) == rows(reports.top_traded(t, day=day))
    got = spark.sql("SELECT * FROM price_history('Brand#11', :d, 6)", args={"d": day})
    want = reports.price_history(p, day, 6, "Brand#11").select(*got.columns)
    assert rows(got) == rows(want) and got.count() > 0
    assert spark.sql("SELECT * FROM customer_pnl(-5)").isEmpty()


def test_parameters_reach_the_scans(spark):
    procedures.install(spark, fx.trades(spark, SF001), fx.prices(spark, SF001))
    pnl = plan(spark.sql("SELECT * FROM customer_pnl(17)"))
    assert "EqualTo(o_custkey,17)" in pnl and "EqualTo(l_suppkey,17)" in pnl and "Pandas" not in pnl
    top = plan(spark.sql("SELECT * FROM top_traded(DATE'1999-01-04')"))
    assert "GreaterThanOrEqual(l_shipdate" in top and "LessThan(l_shipdate" in top
    assert "EqualTo(p_brand,Brand#11)" in plan(spark.sql("SELECT * FROM price_history('Brand#11', DATE'1999-01-04', 12)"))


def test_settlement_script(spark):
    folder, tag = scratch_path(spark, "settle-sql"), scratch_path(spark, "x").rsplit("-", 1)[1]
    totals, log = f"totals_{tag}", f"log_{tag}"
    t = fx.trades(spark, SF001)
    t.createOrReplaceTempView("settle_trades")
    procedures.create_settlement_tables(spark, totals, log, folder)
    days = [r[0] for r in t.select(F.to_date("trade_time").alias("d")).distinct().orderBy("d").limit(3).collect()]
    for day in (days[0], days[1], days[0], days[2]):                          # one day twice
        out = spark.sql(procedures.settlement_script(day, "settle_trades", totals, log)).first()
        assert out.settlement_date == day and out.trades > 0
    empty = dt.date(1900, 1, 1)
    assert spark.sql(procedures.settlement_script(empty, "settle_trades", totals, log)).first().trades == 0
    want = settlement.trade_totals(t).where(F.col("trade_date").isin(days))
    assert rows(spark.table(totals).select("symbol", "trade_date", "total_qty", "total_value")) == rows(want)
    assert [(r.settlement_id, r.settlement_date, r.status) for r in spark.table(log).orderBy("settlement_id").collect()] == \
        [(1, days[0], "COMPLETED"), (2, days[1], "COMPLETED"), (3, days[2], "COMPLETED"), (4, empty, "COMPLETED")]
    for name in (totals, log):
        spark.sql(f"DROP TABLE {name}")
