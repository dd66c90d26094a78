"""The confirmation worker: attempts by a stub clock, one request at a time, and rates written to the store."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tickweave.sources import store
from tickweave.streaming import confirm
from tickweave.streaming.confirm import Confirmations

MINUTE = 60_000
T0 = 1_800_000_000_000


def run(own, until, found=lambda key, attempt: False, start=T0):
    """Lets the clock go from one moment at which something is due to the next; tells when each request went out."""
    out, now = [], start
    while own.next_at() is not None and own.next_at() <= until:
        now = max(now, own.next_at())
        key, _, attempt = own.ask(now)
        out.append((key[0], attempt, now - T0))
        if found(key, attempt):
            own.confirmed(key, now)
    return out


def test_four_attempts_and_then_no_more():
    own = Confirmations()
    own.schedule((1, T0), "A", T0)
    assert run(own, T0 + 10**9) == [(1, 0, 2 * MINUTE), (1, 1, 5 * MINUTE), (1, 2, 15 * MINUTE), (1, 3, 60 * MINUTE)]
    own.schedule((1, T0), "A", T0 + 61 * MINUTE)  # given up: not taken again for two days
    assert own.next_at() is None
    own.schedule((2, T0), "B", T0 + 50 * 3_600_000)
    own.schedule((1, T0), "A", T0 + 50 * 3_600_000)
    assert set(own.open) == {(2, T0), (1, T0)}


def test_an_answer_ends_it():
    own = Confirmations()
    for k in range(3):
        own.schedule((k, T0), f"S{k}", T0)
    got = run(own, T0 + 10**9, found=lambda key, attempt: key[0] == 1 or attempt == 1)
    second = 1000
    assert got == [(0, 0, 2 * MINUTE), (1, 0, 2 * MINUTE + second), (2, 0, 2 * MINUTE + 2 * second), (0, 1, 5 * MINUTE), (2, 1, 5 * MINUTE + second)]
    own.confirmed((9, T0), T0)  # somebody else's
    own.schedule((9, T0), "S9", T0)
    assert own.next_at() is None


def test_late_settlements_start_where_the_delays_are():
    for late, attempt, due in ((1, 0, 2), (2, 0, 2), (7, 1, 7), (59, 2, 59), (60, 3, 60), (900, 3, 900)):
        own = Confirmations()
        own.schedule((1, T0), "A", T0 + late * MINUTE)
        assert own.open[1, T0] == ("A", attempt, T0 + due * MINUTE)


def test_requests_keep_their_distance():
    own = Confirmations(spacing=1)
    for k in range(500):
        own.schedule((k, T0 - 3_600_000), "S", T0)
    got = [at for _, _, at in run(own, T0 + 10**9)]
    assert len(got) == 500 and all(b - a == 1000 for a, b in zip(got, got[1:], strict=False))  # 500 in 499 seconds


HOUR = (datetime.now(timezone.utc) - timedelta(hours=3)).replace(minute=0, second=0, microsecond=0)


def exchanges():
    """Two exchanges that know one settlement each; tasks get the function by value."""
    millis = int(HOUR.timestamp() * 1000)

    def stub(url, attempts):
        assert attempts == 1
        if "symbol=AAA" in url and f"startTime={millis}&endTime={millis + 1}&" in url:
            return json.dumps([{"symbol": "AAA", "fundingTime": millis, "fundingRate": "0.0007"}])
        if "instId=B-USDT-SWAP" in url:
            return json.dumps({"code": "0", "data": [{"instId": "B-USDT-SWAP", "fundingTime": str(millis), "realizedRate": "-0.0002", "fundingRate": "9"}]})
        raise OSError("down")

    return stub


def test_stream_writes_what_is_answered(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS asked CASCADE")
    store.init(spark, "asked")
    rows = [("Binance", "task", 1, "AAA", HOUR), ("OKX", "task", 2, "B-USDT-SWAP", HOUR), ("Binance", "task", 3, "CCC", HOUR), ("OKX", "task", 4, "D", HOUR), ("OKX", "confirmed", 4, None, HOUR)]
    spark.createDataFrame(rows, confirm.NEWS).coalesce(1).write.parquet(str(tmp_path / "news"))
    news = spark.readStream.schema(confirm.NEWS).parquet(str(tmp_path / "news"))
    instruments = spark.createDataFrame([(1, "Binance", "AAA"), (2, "OKX", "B-USDT-SWAP"), (3, "Binance", "CCC"), (4, "OKX", "D")], "instrument_id long, exchange string, exchange_symbol string")
    news = news.unionByName(confirm.confirmed(spark, "asked", instruments))
    query = confirm.confirm(news, "asked", str(tmp_path / "seen"), exchanges(), trigger="500 milliseconds")
    try:
        for _ in range(60):
            time.sleep(1)
            done = {(r.instrument_id, r.rate, r.is_actual) for r in store.read(spark, "asked", "funding_rate_hourly").collect()}
            if len(done) == 2 or query.exception() is not None:
                break
    finally:
        query.stop()
    assert query.exception() is None
    assert done == {(1, Decimal("0.000700000000000000"), True), (2, Decimal("-0.000200000000000000"), True)}  # 3 stays open, 4 was not asked for


def test_answers_without_a_rate(spark):
    asked = spark.createDataFrame([("Binance", 3, "CCC", HOUR, 0), ("Binance", 1, "AAA", HOUR, 0)], confirm.REQUEST)
    assert {(r.instrument_id, None if r.rate is None else str(r.rate)[:6]) for r in confirm.answers(asked, exchanges()).collect()} == {(3, None), (1, "0.0007")}
    assert confirm.answers(asked.where(F.lit(False)), exchanges()).collect() == []
