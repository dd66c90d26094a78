from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave import cli
from tickweave.operators import replay, sampler, validate
from tickweave.sources import store

SAMPLES = "instrument_id long, minute long, second int, side string, price long, qty decimal(20,0)"
SECONDS = "instrument_id long, minute long, second int"


def frames(spark, books):
    """books: {(instrument, minute, second): (bids, asks) or None for invalid}"""
    rows = [(*k, side, p, Decimal(q)) for k, v in books.items() if v for side, levels in zip(("bid", "ask"), v, strict=True) for p, q in levels.items()]
    return spark.createDataFrame(rows, SAMPLES), spark.createDataFrame([k for k, v in books.items() if v], SECONDS)


def test_one_minute(spark):
    a = ({100: 5, 99: 6 - 3}, {101: 5})
    b = ({100: 9, 98: 6}, {101: 5})
    samples, seconds = frames(spark, {(1, 1, 0): a, (1, 1, 1): a, (1, 1, 2): None, (1, 1, 3): b})
    minutes, deltas = sampler.encode(samples, seconds)
    assert minutes.first().valid_bitmap == 0b1011
    (d,) = deltas.collect()
    assert (d.second_offset, d.bid_change_prices, [int(q) for q in d.bid_change_qtys], d.ask_change_prices) == (3, [100, 99, 98], [9, 0, 6], [])
    assert replay.at_second(minutes, deltas, 2).count() == 0
    with pytest.raises(ValueError):
        replay.at_second(minutes, deltas, 60)


def test_no_anchor_no_minute(spark):
    samples, seconds = frames(spark, {(1, 1, 0): None, (1, 1, 1): ({1: 1}, {2: 1})})
    minutes, deltas = sampler.encode(samples, seconds)
    assert minutes.count() == 0 and deltas.count() == 0


def test_random_round_trip(spark):
    rng, books = random.Random(5), {}
    for instrument in (1, 2):
        for minute in range(3):
            for second in range(60):
                if rng.random() < 0.15 and (second or minute == 2):
                    books[instrument, minute, second] = None
                    continue
                bids = {100 - i: rng.randint(1, 3) for i in rng.sample(range(70), rng.randint(1, 60))}
                asks = {101 + i: rng.randint(1, 3) for i in rng.sample(range(70), rng.randint(1, 60))}
                books[instrument, minute, second] = (bids, asks)
    samples, seconds = frames(spark, books)
    minutes, deltas = (x.cache() for x in sampler.encode(samples, seconds))
    assert minutes.select(F.explode(validate.minute())).count() == 0 and deltas.select(F.explode(validate.delta())).count() == 0
    assert validate.orphan_deltas(minutes, deltas).count() == 0
    expected = set()
    for (i, m, s), v in books.items():
        if v and books[i, m, 0]:
            for side, levels, down in (("bid", v[0], True), ("ask", v[1], False)):
                expected |= {((m << 32) | i, s, side, p, q) for p, q in sorted(levels.items(), reverse=down)[:50]}
    got = {(x.minute_id, x.second, x.side, x.price, int(x.qty)) for x in replay.every_second(minutes, deltas).collect()}
    assert got == expected
    for second in (0, 17, 59):
        at = {(x.minute_id, second, x.side, x.price, int(x.qty)) for x in replay.at_second(minutes, deltas, second).collect()}
        assert at == {x for x in expected if x[1] == second}
    back = sampler.narrow(sampler.widen(minutes))
    assert back.exceptAll(minutes.select(back.columns)).count() == 0


def test_grid_from_states(spark):
    t = datetime(2026, 1, 1)
    states = spark.createDataFrame([(1, t + timedelta(milliseconds=200), t + timedelta(seconds=3), "a"), (1, t + timedelta(seconds=3), t + timedelta(milliseconds=3400), "b")], "instrument_id int, from_time timestamp, to_time timestamp, s string")
    got = [(x.second_time.second, x.s) for x in sampler.sample_grid(states).orderBy("second_time").collect()]
    assert got == [(1, "a"), (2, "a"), (3, "b")]


def test_padding_inside_a_side_is_an_error(spark):
    samples, seconds = frames(spark, {(1, 1, 0): ({100: 5}, {101: 5})})
    wide = sampler.widen(sampler.encode(samples, seconds)[0]).withColumn("bid_price_03", F.lit(7).cast("long")).withColumn("bid_qty_03", F.lit(7).cast("decimal(20,0)"))
    with pytest.raises(Exception, match="padding"):
        sampler.narrow(wide).collect()


def test_store_and_replay(spark, tmp_path, monkeypatch, capsys):
    spark.sql("DROP DATABASE IF EXISTS bookstore CASCADE")
    store.init(spark, "bookstore")
    start = int(datetime(2026, 8, 19, 12, 34, tzinfo=timezone.utc).timestamp()) // 60
    books = {(7, start, s): ({100: s + 1}, {101: 5}) for s in range(60)}
    minutes, deltas = (x.cache() for x in sampler.encode(*frames(spark, books)))
    for n in (1, 2):  # the same rows again change nothing
        store.write_minutes(minutes, deltas, "bookstore", F.lit(n))
    stored = store.read(spark, "bookstore", "order_book_minute", "instrument_id = 7", ["202608"])
    plan = stored._jdf.queryExecution().toString()
    assert stored.count() == 1 and "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(instrument_id)" in plan
    monkeypatch.setenv("TICKWEAVE_DATABASE", "bookstore")
    (out,) = cli.main(["--replay-instrument", "7", "--replay-time", "2026-08-19T12:34:59Z"], spark)
    assert '"valid":true' in out and '"bid_qtys":[60]' in out
    with pytest.raises(SystemExit):
        cli.main(["--replay-instrument", "8", "--replay-time", "2026-08-19T12:34:59Z"], spark)
    with pytest.raises(ValueError):
        store.write_minutes(minutes.withColumn("valid_bitmap", F.lit(2).cast("long")), deltas, "bookstore", F.lit(3))
    assert store.compact(spark, "bookstore", "order_book_second_delta") == ["202608"]
    assert len(cli.main(["--print-ddl"])) == 6
    instrument = (1, "OKX", "perpetual", "ZOR-USDT-SWAP", "ZOR", "USDT", "USDT", "0.015", "0.2", "2", None)
    rows = spark.createDataFrame([instrument, instrument[:2] + ("margin",) + instrument[3:]], "a int, b string, c string, d string, e string, f string, g string, h string, i string, j string, k timestamp")
    named = rows.toDF(*[x.name for x in __import__("tickweave.schemas", fromlist=["x"]).INSTRUMENT])
    store.append(named.where("market_type = 'perpetual'"), "bookstore", "instrument", F.lit(1))
    assert store.instruments(spark, "bookstore").first().exchange == "OKX"
    store.append(named.where("market_type = 'margin'"), "bookstore", "instrument", F.lit(2))
    with pytest.raises(Exception, match="market_type"):
        store.instruments(spark, "bookstore").collect()
