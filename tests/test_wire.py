from __future__ import annotations

import json
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tickweave.operators.validate import VIOLATIONS
from tickweave.sources import binance, okx


def feed(spark, payload, **columns):
    df = spark.createDataFrame([(payload if isinstance(payload, str) else json.dumps(payload),)], "payload string")
    for name, value in columns.items():
        df = df.withColumn(name, F.lit(value) if not isinstance(value, Decimal) else F.lit(str(value)).cast("decimal(38,18)"))
    return df


STEPS = {"price_tick_size": Decimal("0.1"), "quantity_step_size": Decimal("0.001")}
OKX_STEPS = {"price_tick_size": Decimal("0.1"), "quantity_step_size": Decimal("1")}


def symbol(name, **more):
    filters = [{"filterType": "PRICE_FILTER", "tickSize": "0.0500"}, {"filterType": "LOT_SIZE", "stepSize": "0.002"}]
    return {"symbol": name, "status": "TRADING", "contractType": "PERPETUAL", "baseAsset": "ZOR", "quoteAsset": "USDT", "marginAsset": "USDT", "filters": filters} | more


def test_exchange_info(spark):
    payload = {"symbols": [symbol("ZORUSDT"), symbol("OLD", status="BREAK"), symbol("ZORUSD", marginAsset="ZOR"), symbol("Q", contractType="CURRENT_QUARTER")]}
    (row,) = binance.instruments(feed(spark, payload), "perpetual").collect()
    assert row.exchange_symbol == "ZORUSDT" and row.settle_asset == "USDT" and row.price_tick_size == Decimal("0.05") and row[VIOLATIONS] == []
    twice = symbol("A")
    twice["filters"] = twice["filters"] + twice["filters"][:1]
    assert binance.instruments(feed(spark, {"symbols": [twice]}), "perpetual").first()[VIOLATIONS] == ["price_filter"]
    assert "twice" in binance.instruments(feed(spark, {"symbols": [symbol("A"), symbol("A")]}), "spot").first()[VIOLATIONS]
    assert "symbols" in binance.instruments(feed(spark, "{oops"), "spot").first()[VIOLATIONS]


def test_binance_snapshot(spark):
    now = datetime(2026, 1, 1)
    good = {"lastUpdateId": 100, "bids": [["100.1", "1.5"]], "asks": [["100.2", "2"]]}
    row = binance.depth_snapshots(feed(spark, good, received_time=now, **STEPS)).first()
    assert row[VIOLATIONS] == [] and row.source_time == now and (row.bids[0].price, int(row.bids[0].qty)) == (1001, 1500)
    for change, code in [({"lastUpdateId": 0}, "last_update_id"), ({"bids": [[100.1, "1"]]}, "bids"), ({"bids": [["100.15", "1"]]}, "bids"), ({"bids": [["100.1", "0"]]}, "bids")]:
        assert code in binance.depth_snapshots(feed(spark, good | change, received_time=now, **STEPS)).first()[VIOLATIONS]
    crossed = good | {"bids": [["100.2", "1"]]}
    assert binance.depth_snapshots(feed(spark, crossed, received_time=now, **STEPS)).first()[VIOLATIONS] == ["crossed"]


def test_binance_update(spark):
    good = {"e": "depthUpdate", "E": 5, "T": 7, "s": "ZORUSDT", "U": 100, "u": 101, "pu": 99, "b": [["100.1", "0"]], "a": []}
    known = {"exchange_symbol": "ZORUSDT", "market_type": "perpetual"} | STEPS
    row = binance.depth_updates(feed(spark, {"stream": "zorusdt@depth", "data": good}, **known)).first()
    assert row[VIOLATIONS] == [] and (row.first_id, row.final_id, row.prev_id) == (100, 101, 99) and row.source_time.microsecond == 7000
    assert binance.depth_updates(feed(spark, good, **known | {"market_type": "spot"})).first().source_time.microsecond == 5000
    for change, code in [({"U": 102}, "ids"), ({"pu": 0}, "prev_id"), ({"s": "zorusdt"}, "symbol"), ({"e": "x"}, "event"), ({"b": [["1", "1"], ["1", "2"]]}, "bids")]:
        assert code in binance.depth_updates(feed(spark, good | change, **known)).first()[VIOLATIONS]
    assert "stream" in binance.depth_updates(feed(spark, {"stream": "kepusdt@depth", "data": good}, **known)).first()[VIOLATIONS]


def test_mark_price_and_history(spark):
    dim = spark.createDataFrame([(1, "ZORUSDT", "perpetual")], "instrument_id long, exchange_symbol string, market_type string")
    row = binance.mark_prices(feed(spark, {"e": "markPriceUpdate", "E": 9, "s": "ZORUSDT", "r": "0.0001", "T": 1800000}), dim).first()
    assert row.instrument_id == 1 and row.rate == Decimal("0.0001") and row[VIOLATIONS] == []
    assert binance.mark_prices(feed(spark, {"result": None, "id": 1}), dim).count() == 0
    assert "control" in binance.mark_prices(feed(spark, {"code": 2, "msg": "x"}), dim).first()[VIOLATIONS]
    time = datetime(2026, 1, 1, 8, tzinfo=timezone.utc)
    ms = int(time.timestamp() * 1000)
    for shift, found in ((0, True), (1, False)):
        payload = [{"symbol": "ZORUSDT", "fundingRate": "0.0002", "fundingTime": ms + shift}]
        got = binance.funding_history(feed(spark, payload, instrument_id=1, exchange_symbol="ZORUSDT", funding_time=time)).first()
        assert (got.rate is not None) == found and got.is_actual


def test_okx_instruments(spark):
    item = dict(instType="SWAP", instId="ZOR-USDT-SWAP", state="live", baseCcy="", quoteCcy="", settleCcy="USDT", ctType="linear", ctVal="0.005", ctMult="3", ctValCcy="ZOR", tickSz="0.2", lotSz="2")
    (row,) = okx.instruments(feed(spark, {"code": "0", "msg": "", "data": [item, item | {"instId": "X-USD-SWAP", "ctType": "inverse"}]}), "perpetual").collect()
    assert row.base_asset == "ZOR" and row.contract_multiplier == Decimal("0.015") and row[VIOLATIONS] == []
    for change, code in [({"ctValCcy": "USD"}, "contract_asset"), ({"instId": "ZOR-USDT"}, "name"), ({"ctVal": "0"}, "contract")]:
        assert code in okx.instruments(feed(spark, {"code": "0", "data": [item | change]}), "perpetual").first()[VIOLATIONS]
    assert "code" in okx.instruments(feed(spark, {"code": "1", "data": []}), "perpetual").first()[VIOLATIONS]
    spot = dict(instType="SPOT", instId="ZOR-USDT", state="live", baseCcy="ZOR", quoteCcy="USDT", settleCcy="", tickSz="0.3", lotSz="0.004")
    assert okx.instruments(feed(spark, {"code": "0", "data": [spot]}), "spot").first()[VIOLATIONS] == []


def test_okx_depth(spark):
    def message(action="snapshot", **change):
        item = {"asks": [["100.2", "3", "0", "1"]], "bids": [["100.1", "2", "0", "4"]], "ts": "1700000000123", "prevSeqId": -1 if action == "snapshot" else 10, "seqId": 10}
        return {"arg": {"channel": "books", "instId": "ZOR-USDT-SWAP"}, "action": action, "data": [item | change]}

    known = {"exchange_symbol": "ZOR-USDT-SWAP"} | OKX_STEPS
    row = okx.depth(feed(spark, message(), **known)).first()
    assert row[VIOLATIONS] == [] and row.kind == "snapshot" and row.bids[0].price == 1001
    assert okx.depth(feed(spark, message("update", bids=[], asks=[["100.2", "0", "0", "0"]]), **known)).first()[VIOLATIONS] == []
    assert okx.depth(feed(spark, message("update", seqId="11"), **known)).first().final_id == 11
    for change, code in [({"bids": []}, "bids"), ({"prevSeqId": 3}, "prev_id"), ({"ts": 5}, "source_time"), ({"asks": [["100.2", "3", "1", "1"]]}, "asks"), ({"asks": [["100.2", "0", "0", "1"]]}, "asks")]:
        assert code in okx.depth(feed(spark, message(**change), **known)).first()[VIOLATIONS], change
    assert okx.depth(feed(spark, "pong", **known)).count() == 0
    assert okx.control(feed(spark, {"event": "subscribe", "arg": {}}))[1].count() == 0
    assert okx.control(feed(spark, {"event": "subscribe", "code": "0"}))[1].count() == 0
    assert okx.control(feed(spark, {"event": "error", "code": "60012"}))[1].count() == 1


def test_okx_funding(spark):
    dim = spark.createDataFrame([(2, "ZOR-USDT-SWAP", "perpetual")], "instrument_id long, exchange_symbol string, market_type string")
    rows = [{"instId": "", "instType": "SWAP", "fundingRate": "0.0003", "fundingTime": "1700006400000", "ts": "1700000000000"}, {"instId": "KEP-USDT-SWAP", "instType": "", "fundingRate": "0.1", "fundingTime": "1", "ts": "1"}]
    got = okx.funding_updates(feed(spark, {"arg": {"channel": "funding-rate", "instId": "ZOR-USDT-SWAP"}, "data": rows}), dim).collect()
    assert sorted(len(x[VIOLATIONS]) for x in got) == [0, 1] and len(got) == 2
    time = datetime(2026, 1, 1, 8, tzinfo=timezone.utc)
    ms = str(int(time.timestamp() * 1000))
    for realized, rate in (("0.0005", Decimal("0.0005")), ("", None)):
        payload = {"code": "0", "data": [{"instId": "ZOR-USDT-SWAP", "fundingRate": "0.9", "realizedRate": realized, "fundingTime": ms}]}
        got = okx.funding_history(feed(spark, payload, instrument_id=2, exchange_symbol="ZOR-USDT-SWAP", funding_time=time)).first()
        assert got.rate == rate and got[VIOLATIONS] == []


def test_what_a_payload_holds_is_worked_out_once(spark):
    """Rows of texts, and the decimals in them, are made once for each side, however many rules look at them."""
    from pyspark.sql import functions as F

    step = F.lit("0.5").cast("decimal(38,18)")
    rows = spark.createDataFrame([("{}", "A", "spot")], "payload string, exchange_symbol string, market_type string").select(
        "*", step.alias("price_tick_size"), step.alias("quantity_step_size"), F.timestamp_seconds(F.lit(0)).alias("received_time")
    )
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    for made in (binance.depth_snapshots(rows), binance.depth_updates(rows), okx.depth(rows)):
        plan = made._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("from_json") == 2
        assert plan.count("rtrim") == 4  # a price and a quantity of each side
    spark.conf.unset("spark.sql.debug.maxToStringFields")
