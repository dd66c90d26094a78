from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tickweave import cli, schemas
from tickweave.operators import book, replay, sampler
from tickweave.operators.book import INVALID, VALID, Book, BookError, Feed
from tickweave.sources import feed as feeds, store
from tickweave.streaming import books as streaming

T0 = datetime(2026, 1, 1)


def event(kind, final, bids=(), asks=(), first=None, prev=None, seq=0):
    return {"kind": kind, "first_id": first, "final_id": final, "prev_id": prev, "source_time": T0, "bids": list(bids), "asks": list(asks), "instrument_id": 1, "arrival_seq": seq, "arrival_time": T0}


def test_set_delete_and_last_value():
    b = Book(1000)
    b.apply_snapshot(10, T0, [(100, 5), (99, 2)], [(101, 3)])
    b.apply_changes(10, 11, T0, [(100, 7), (99, 0)], [])
    assert b.top() == ([(100, 7)], [(101, 3)])
    b.state = INVALID
    assert b.top() is None


def test_crossed_is_undone():
    b = Book(1000)
    b.apply_snapshot(1, T0, [(100, 1)], [(101, 1)])
    for price in (101, 102):
        with pytest.raises(BookError):
            b.apply_changes(1, 2, T0, [(price, 1)], [])
    assert b.top()[0] == [(100, 1)] and b.sequence == 1


def test_rejections_leave_the_book():
    b = Book(1000)
    b.apply_snapshot(5, T0, [(100, 1)], [(101, 1)])
    bad = [(5, 5, T0, [(99, 1)]), (4, 6, T0, [(99, 1)]), (5, 6, None, [(99, 1)]), (5, 6, T0, [(99, 1), (99, 2)]), (5, 6, T0, [(0, 1)])]
    for expected, sequence, time, bids in bad:
        with pytest.raises(BookError):
            b.apply_changes(expected, sequence, time, bids, [])
    assert b.top() == ([(100, 1)], [(101, 1)])
    with pytest.raises(BookError):
        b.apply_snapshot(9, T0, [(101, 1)], [(101, 1)])
    assert b.sequence == 5
    with pytest.raises(BookError):
        Book(49)


def test_trim_and_lost_depth():
    b = Book(60)
    b.apply_snapshot(1, T0, [(1000 - i, 1) for i in range(60)], [(2000, 1)])
    assert b.complete == [False, True]
    b.apply_changes(1, 2, T0, [(1001, 1)], [])
    assert len(b.bids) == 60 and 941 not in b.bids.qty
    b.apply_changes(2, 3, T0, [(1001 - i, 0) for i in range(11)], [])
    assert b.state == INVALID and b.sequence == 2


def test_binance_continuity():
    f = Feed.of("Binance", "perpetual")
    assert f.apply(event("update", 101, [(99, 1)], first=100, prev=99)) is not None  # waits for the snapshot
    f.apply(event("snapshot", 100, [(100, 1)], [(102, 1)]))
    assert f.last == 101 and (99, 1) in f.book.top()[0]
    assert f.apply(event("update", 101, [(98, 1)], first=101, prev=100)) is None  # old
    assert f.apply(event("update", 105, [(97, 1)], first=104, prev=102)) == "gap" and f.book.state == INVALID
    spot = Feed.of("Binance", "spot")
    spot.apply(event("snapshot", 100, [(100, 1)], [(102, 1)]))
    assert spot.apply(event("update", 103, [(99, 1)], first=101)) is None and spot.last == 103
    assert spot.apply(event("update", 106, [(98, 1)], first=105)) == "gap"
    late = Feed.of("Binance", "spot")
    late.apply(event("snapshot", 100, [(100, 1)], [(102, 1)]))
    assert "bridge" in late.apply(event("update", 110, first=105))


def test_okx_continuity():
    f = Feed.of("OKX", "perpetual")
    assert f.apply(event("update", 11, prev=10)) == "no snapshot yet"
    f.apply(event("snapshot", 10, [(100, 1)], [(102, 1)], prev=-1))
    assert f.apply(event("update", 10, prev=10)) is None  # heartbeat
    assert f.apply(event("update", 12, [(99, 1)], prev=11)) == "gap"
    assert f.apply(event("update", 13, [(99, 1)], prev=12)) == "no snapshot yet"
    f.apply(event("snapshot", 100, [(100, 1)], [(102, 1)], prev=-1))
    assert f.apply(event("update", 1, prev=100)) == "sequence reset" and f.book.state == INVALID
    f.apply(event("snapshot", 5, [(100, 1)], [(102, 1)], prev=-1))
    assert f.apply(event("update", 6, [(99, 4)], prev=5)) is None and f.book.state == VALID


def _log(spark):
    def row(seq, kind, final, prev, bids, asks, after=0):
        return (7, "OKX", "perpetual", 1, seq, T0 + timedelta(seconds=seq + after), kind, None, final, prev, T0, bids, asks)

    rows = [row(0, "snapshot", 1, -1, [(100, 5)], [(102, 5)])]
    rows += [row(i, "update", i + 1, i, [(100 - i % 3, i % 5)], [(103 + i % 4, 1)]) for i in range(1, 30)]
    rows += [row(30, "update", 40, 35, [], []), row(31, "snapshot", 50, -1, [(90, 1)], [(95, 1)])]
    return spark.createDataFrame([r[:11] + tuple([(p, Decimal(q)) for p, q in side] for side in r[11:]) for r in rows], schemas.BOOK_EVENT)


def test_batch_and_stream_agree(spark, tmp_path):
    log = _log(spark)
    batch = [tuple(x) for x in book.replay_log(log).orderBy("arrival_seq").collect()]
    assert len(batch) == 32 and batch[30][3] == INVALID and batch[31][3] == VALID and batch[30][5] == "gap"
    source = tmp_path / "log"
    log.where("arrival_seq < 10").coalesce(1).write.parquet(str(source))
    seen = str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.schema(schemas.BOOK_EVENT).parquet(str(source))
        streaming.append_each_batch(streaming.books(stream), str(tmp_path / "out"), seen).awaitTermination(120)

    run()
    log.where("arrival_seq >= 10").coalesce(1).write.mode("append").parquet(str(source))
    run()  # a new query takes up the state where the last one left it
    got = [tuple(x) for x in spark.read.parquet(str(tmp_path / "out")).select(*book.VIEW.names).orderBy("arrival_seq").collect()]
    assert got == batch


def test_faults_become_rows(spark):
    log = _log(spark).where("arrival_seq < 3")
    late = log.withColumn("arrival_time", log["arrival_time"] + (log["arrival_seq"] * 100).cast("string").cast("int") * __import__("pyspark").sql.functions.expr("interval 1 second"))
    rows = feeds.with_faults(late).orderBy("arrival_seq").collect()
    assert [x.kind for x in rows] == ["snapshot", "invalidate", "update", "invalidate", "update"]


def test_set_based_continuity(spark):
    rows = spark.createDataFrame([(1, 1, 0, 1, 5), (1, 2, 5, 6, 7), (1, 3, 5, 6, 7), (1, 4, 8, 9, 10)], "k int, arrival_seq int, prev_id int, first_id int, final_id int")
    assert [(x.arrival_seq, x.gap) for x in book.chain_breaks(rows, ["k"]).orderBy("arrival_seq").collect()] == [(1, False), (2, False), (4, True)]
    assert [(x.arrival_seq, x.gap) for x in book.range_breaks(rows, ["k"]).orderBy("arrival_seq").collect()] == [(1, False), (2, False), (4, True)]


def test_stream_of_minutes_is_the_batch(spark, tmp_path, monkeypatch):
    """Three minutes of one book, with a gap in the second and a snapshot after it: stored rows and deltas as in batch."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    start = datetime(2026, 1, 2, 3, 4, 0)

    def row(seq, kind, prev, bids, asks, at):
        return (7, "OKX", "perpetual", 1, seq, start + timedelta(seconds=at), kind, None, seq + 1, prev, T0, [(p, Decimal(q)) for p, q in bids], [(p, Decimal(q)) for p, q in asks])

    rows = [row(0, "snapshot", -1, [(100, 5), (99, 2)], [(102, 5)], 0)]
    for i in range(1, 60):
        at = i * 3.3
        if i == 25:
            rows.append(row(i, "update", 3, [], [(103, 1)], at))  # a gap: invalid until the snapshot
        elif i == 30:
            rows.append(row(i, "snapshot", -1, [(98, 1)], [(101, 1)], at))
        else:
            rows.append(row(i, "update", i, [(100 - i % 4, i % 3)], [(102 + i % 2, 1 + i % 2)], at))
    log = spark.createDataFrame(rows, schemas.BOOK_EVENT)
    views = book.replay_log(log).withColumn("to_time", F.lead("arrival_time").over(Window.partitionBy("instrument_id").orderBy("arrival_seq"))).withColumnRenamed("arrival_time", "from_time")
    grid = sampler.sample_grid(views).where("state = 'valid' and size(bid_prices) > 0")
    at = F.unix_seconds("second_time")
    seconds = grid.select("instrument_id", F.floor(at / 60).cast("long").alias("minute"), (at % 60).cast("int").alias("second"), "bid_prices", "bid_qtys", "ask_prices", "ask_qtys")
    levels = seconds.select("instrument_id", "minute", "second", F.inline(replay.levels("prices", "qtys"))).withColumn("qty", F.col("qty").cast("decimal(20,0)"))
    minutes, deltas = sampler.encode(levels, seconds.select("instrument_id", "minute", "second"))
    last = max(x.minute for x in seconds.collect())
    plain = lambda df, key: sorted(tuple(map(str, x)) for x in df.orderBy(*key).collect())
    source, seen = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for part in (log.where("arrival_seq < 20"), log.where("arrival_seq >= 20")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.BOOK_EVENT).parquet(source)
        streaming.append_each_batch(streaming.minutes(stream), str(tmp_path / "out"), seen).awaitTermination(120)
    got_minutes, got_deltas = streaming.split_minutes(spark.read.parquet(str(tmp_path / "out")))
    whole = minutes.where(F.unix_seconds("minute_time") < last * 60)
    names = [x.name for x in schemas.MINUTE]
    assert plain(got_minutes.select(names), ["id"]) == plain(whole.select(names), ["id"]) and whole.count() == 3
    kept = deltas.join(whole.select(F.col("id").alias("minute_id")), "minute_id", "left_semi")
    names = [x.name for x in schemas.DELTA]
    assert plain(got_deltas.select(names), ["minute_id", "second_offset"]) == plain(kept.select(names), ["minute_id", "second_offset"]) and kept.count() > 20
    monkeypatch.setenv("TICKWEAVE_DATABASE", "collected")
    for _ in range(2):  # nothing new, nothing stored again
        cli.main(["--collect", source, "--checkpoint", str(tmp_path / "collected")], spark)
    names = [x.name for x in schemas.MINUTE]
    assert plain(store.read(spark, "collected", "order_book_minute").select(names), ["id"]) == plain(whole.select(names), ["id"])
    assert store.read(spark, "collected", "order_book_second_delta").count() == kept.count()
    second = start + timedelta(seconds=17)
    (out,) = cli.main(["--replay-instrument", "7", "--replay-time", second.strftime("%Y-%m-%dT%H:%M:%SZ")], spark)
    view = views.where((F.col("from_time") <= F.lit(second)) & (F.col("to_time") > F.lit(second))).first()
    assert json.loads(out)["snapshot"]["bid_prices"] == view.bid_prices


def test_stream_of_estimates(spark, tmp_path):
    hour = datetime(2026, 1, 2, 8)
    schema = "instrument_id long, kind string, arrival_seq long, funding_time timestamp, rate decimal(38,18), source_time timestamp"
    put = lambda seq, rate, ago, target=hour: (1, "estimate", seq, target, Decimal(rate), hour - timedelta(seconds=ago))
    rows = [put(0, "0.1", 90), put(1, "0.2", 95), put(2, "0.3", 90), (1, "unavailable", 3, None, None, None), put(4, "0.4", 99), put(5, "0.5", 10), put(6, "0.6", 5, hour + timedelta(hours=8))]
    source, seen = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.append_each_batch(streaming.latest_estimates(stream), str(tmp_path / "out"), seen).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("_ingest_seq").collect()
    # an older one is passed over, an equal source time replaces, and only what is taken ends an outage
    assert [(str(x.rate)[:3] if x.rate is not None else None, x.available) for x in got] == [("0.1", True), ("0.3", True), (None, False), ("0.5", True), ("0.6", True)]
