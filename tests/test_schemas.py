import pytest

from tickbook import schemas
from tickbook.operators import bars, holdings, matching, risk, settlement, star
from tickbook.sources import fixtures as fx

from .conftest import SF001


def _cols(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _model(table):
    return {f.name: f.dataType.simpleString() for f in schemas.schema(table).fields}


@pytest.mark.parametrize("table,build", [
    ("holdings", lambda s: holdings.holdings(fx.trades(s, SF001))),
    ("orders", lambda s: matching.orders_after_match(fx.book(s, SF001),
                                                     matching.match_price_time(fx.book(s, SF001), with_ids=False))),
    ("fact_tick_agg", lambda s: bars.bars(fx.ticks(s, SF001))),
    ("fact_trade_agg", lambda s: settlement.trade_totals(fx.trades(s, SF001))),
    ("fact_symbol_risk", lambda s: risk.risk_daily(risk.risk_rolling(fx.ticks(s, SF001)))),
    ("fact_settlement", lambda s: settlement.settlement_log(fx.trades(s, SF001))),
    ("dim_symbol", lambda s: star.load_dim_symbol(fx.staged_prices(s, SF001))),
    ("dim_date", lambda s: star.load_dim_date(fx.staged_prices(s, SF001))),
])
def test_operator_outputs_follow_the_model(spark, table, build):
    assert _cols(build(spark)) == _model(table)


def test_matched_trades_carry_the_trade_columns(spark):
    got = _cols(matching.match_price_time(fx.book(spark, SF001)))
    model = _model("trades")
    assert {k: v for k, v in model.items() if k != "trade_time"} == got
