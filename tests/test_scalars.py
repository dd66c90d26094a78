from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave import cli, schemas
from tickweave.functions import decimals, ids
from tickweave.sources import config, feed, rest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "value"),
    [("5.", "5"), (".5", "0.5"), ("-1.25", "-1.25"), ("+1", None), ("1e3", None), (" 1", None), ("", None), (".", None), ("-", None), ("1.2.3", None)]
    + [("1.0000000000000000001", None), ("99999999999999999999", "99999999999999999999"), ("999999999999999999999", None), (None, None)],
)
def test_strict(spark, raw, value):
    got = one(spark, decimals.strict(F.lit(raw).cast("string")))
    assert (None if got is None else got.normalize()) == (None if value is None else Decimal(value).normalize())


@pytest.mark.parametrize(
    ("raw", "step", "tick", "lot"),
    [("60538.10", "0.10", 605381, 605381), ("1.230", "0.001", 1230, 1230), ("1.001", "0.01", None, None), ("-1", "1", None, None), ("0", "1", None, 0)]
    + [("18446744073709551615", "1", None, 2**64 - 1), ("9223372036854775807", "1", 2**63 - 1, 2**63 - 1), ("18446744073709551616", "1", None, None), ("1", "0", None, None)],
)
def test_ticks_and_lots(spark, raw, step, tick, lot):
    value, by = decimals.strict(F.lit(raw)), decimals.strict(F.lit(step))
    assert one(spark, decimals.price_tick(value, by)) == tick
    got = one(spark, decimals.quantity_lot(value, by))
    assert (None if got is None else int(got)) == lot


def test_minute_id_round_trip(spark):
    time = datetime(2026, 8, 19, 1, 23, tzinfo=timezone.utc)
    key = ids.minute_id(F.lit(42), F.timestamp_seconds(F.lit(int(time.timestamp()))))
    assert one(spark, key) == (int(time.timestamp()) // 60 << 32) | 42
    assert one(spark, F.unix_seconds(ids.minute_time(key))) == int(time.timestamp())
    assert one(spark, ids.instrument_of(key)) == 42
    for bad in (0, 2**32):
        assert one(spark, ids.minute_id(F.lit(bad).cast("long"), F.timestamp_seconds(F.lit(0)))) is None


def test_bitmap(spark):
    seconds = spark.range(60).select(F.col("id").cast("int").alias("s"))
    assert seconds.agg(ids.bitmap(F.col("s")).alias("x")).first().x == ids.FULL_MINUTE == 2**60 - 1
    assert seconds.where("s > 99").agg(ids.bitmap(F.col("s")).alias("x")).first().x == 0
    assert one(spark, ids.is_set(F.lit(0b1011).cast("long"), F.lit(2))) is False


def test_ddl():
    statements = schemas.ddl("market")
    assert len(statements) == 6 and len(schemas.minute_columns()) == 204
    assert schemas.minute_columns()[4:6] == ["bid_price_01", "bid_qty_01"]
    with pytest.raises(ValueError):
        schemas.ddl("bad-name")


def test_settings():
    assert config.names(" a, ,b ") == ("a", "b") and config.names("-") == () == config.names("") and config.names(None, ("x",)) == ("x",)
    for bad in ("yes", "1", "TRUE"):
        with pytest.raises(ValueError):
            config.boolean(bad, True)
    for bad in ("0", "-1", "x"):
        with pytest.raises(ValueError):
            config.positive(bad, 1)
    assert config.Config.load({"TICKWEAVE_OKX_SPOT": "ZOR-USDT"}).okx_spot == ("ZOR-USDT",)


def test_cli_arguments():
    got = cli.arguments(["--replay-instrument", "7", "--replay-time", "2026-01-02T03:04:05+01:00"])
    assert got.replay_time == datetime(2026, 1, 2, 2, 4, 5, tzinfo=timezone.utc)
    for bad in (["--replay-instrument", "7"], ["--replay-instrument", str(2**32), "--replay-time", "2026-01-02T03:04:05Z"], ["--replay-instrument", "7", "--replay-time", "noon"]):
        with pytest.raises(SystemExit):
            cli.arguments(bad)


def test_rest_retries(spark):
    import io
    import urllib.error

    calls, waits = [], []

    def answer(codes):
        def open_(url, timeout):
            calls.append(url)
            code = codes[len(calls) - 1]
            if code != 200:
                raise urllib.error.HTTPError(url, code, "", {}, io.BytesIO(b"x" * 2000))
            return io.BytesIO(b"ok")

        return open_

    assert rest.get("u", open_=answer([429, 503, 200]), wait=waits.append) == "ok" and waits == [0.25, 0.5]
    calls.clear()
    with pytest.raises(rest.Refused) as error:
        rest.get("u", open_=answer([404]), wait=waits.append)
    assert len(calls) == 1 and len(str(error.value)) < 600
    calls.clear()
    with pytest.raises(rest.Refused):
        rest.get("u", attempts=1, open_=answer([500]), wait=waits.append)
    assert len(calls) == 1
    requests = spark.createDataFrame([("a",), ("b",)], "url string")
    assert {x.payload for x in rest.fetch(requests, get_=lambda url, n: url * n).collect()} == {"aaaa", "bbbb"}


def test_urls_and_delays():
    assert rest.instruments_url("OKX", "perpetual").endswith("instType=SWAP") and "fapi" in rest.instruments_url("Binance", "perpetual")
    assert "limit=1000" in rest.snapshot_url("ZORUSDT", "spot") and "startTime=5&endTime=6" in rest.funding_history_url("Binance", "ZORUSDT", 5)
    assert rest.stream_names("Binance", ["ZORUSDT"], "depth") == ["zorusdt@depth@100ms"]
    assert [feed.reconnect_delay(k) for k in range(7)] == [1, 2, 4, 8, 16, 30, 30]


def test_tiers_pay_by_their_mode(spark):
    from decimal import Decimal

    from tickweave.operators import yields

    tiers = spark.createDataFrame(
        [(1, 1, "0", "100", "marginal", "0.10"), (1, 2, "100", None, "marginal", "0.02"), (2, 1, "0", "100", "whole_balance", "0.10"), (2, 2, "100", None, "whole_balance", "0.02"), (3, 1, "0", None, "none", "0.05"),
         (4, 1, "0", None, "unknown", "0.05"), (5, 1, "0", "10", "marginal", "0.01"), (5, 2, "10", None, "marginal", None)],
        "yield_route_id long, tier_no int, tier_min_amount string, tier_max_amount string, tier_mode string, rate string",
    )
    asked = {(1, "50"): "5", (1, "100"): "10", (1, "150"): "11", (2, "99.999999999"): "9.9999999999", (2, "100"): "2", (3, "7"): "0.35", (3, "0"): "0", (3, "-1"): "0", (4, "7"): None, (5, "10"): "0.1", (5, "11"): None, (9, "1"): None}
    amounts = spark.createDataFrame([(r, n, Decimal(a)) for n, (r, a) in enumerate(asked)], "yield_route_id long, position_id long, amount decimal(19,9)")
    got = {r.position_id: r.income for r in yields.tiered_income(amounts, tiers).collect()}
    assert [None if got[n] is None else got[n].normalize() for n in range(len(asked))] == [None if x is None else Decimal(x).normalize() for x in asked.values()]
    row = {"reward_asset_keys": ["a"], "reward_component_rates": [None], "rule_principal_loss_mode": "none", "rule_eligibility": "candidate", "fixed_principal_loss_rate": None, "tier_no": 1, "tier_mode": "none", "tier_min_amount": Decimal(0), "tier_max_amount": None}
    schema = "reward_asset_keys array<string>, reward_component_rates array<decimal(38,18)>, rule_principal_loss_mode string, rule_eligibility string, fixed_principal_loss_rate decimal(38,18), tier_no int, tier_mode string, tier_min_amount decimal(38,18), tier_max_amount decimal(38,18)"
    wrong = [{}, {"reward_component_rates": []}, {"rule_principal_loss_mode": "variable"}, {"rule_principal_loss_mode": "fixed"}, {"tier_no": 0}, {"tier_max_amount": Decimal(0)}]
    found = [spark.createDataFrame([row | w], schema).select(yields.observation()).first()[0] for w in wrong]
    assert found == [[], ["reward_lengths"], ["rule_eligibility"], ["fixed_principal_loss_rate"], ["tier_no"], ["tier_amounts"]]
