"""Silence: seconds after it are not valid, minutes end without a later event, and broken minutes are set aside."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave import cli, schemas
from tickweave.operators import collect, ordering
from tickweave.operators.book import Feed, event_of
from tickweave.plans import projection
from tickweave.sources import feed as feeds
from tickweave.sources import store
from tickweave.streaming import books as streaming
from tickweave.streaming.state import BookState, Sampler, SamplerState

START = datetime(2026, 1, 2, 3, 4, 0)


def row(instrument, seq, at, kind="update", prev=None, bids=((100, 1),), asks=(), exchange="OKX", conn=1, first=None):
    prev = (-1 if kind == "snapshot" else seq) if prev is None else prev
    asks = [(102, 5)] if kind == "snapshot" else asks
    return (instrument, exchange, "perpetual", conn, seq, START + timedelta(seconds=at), kind, first, seq + 1, prev, START, [(p, Decimal(q)) for p, q in bids], [(p, Decimal(q)) for p, q in asks])


def as_dict(r):
    return dict(zip(schemas.BOOK_EVENT.names, r, strict=True))


def us(seconds):
    return int((START - datetime(1970, 1, 1)).total_seconds() + seconds) * 1_000_000


def seconds_of(bitmap):
    return [s for s in range(60) if bitmap >> s & 1]


def test_six_hours_of_silence_are_not_valid():
    s = Sampler(7, 45)
    out = s.event(as_dict(row(7, 0, 0, "snapshot"))) + s.event(as_dict(row(7, 1, 10)))
    out += s.event(as_dict(row(7, 2, 6 * 3600)))
    assert [seconds_of(m["valid_bitmap"]) for m in out] == [list(range(55))]
    assert s.feed.book.state == "invalid" and s.next_minute() is None  # the update after it stands on nothing
    out = s.event(as_dict(row(7, 3, 6 * 3600 + 20, "snapshot"))) + s.until(us(6 * 3600 + 90))
    assert out == []  # its first minute has no valid second 0, its second isn't over
    (m,) = s.until(us(6 * 3600 + 600))
    assert seconds_of(m["valid_bitmap"]) == list(range(5)) and m["id"] & 0xFFFFFFFF == 7


def test_an_event_just_in_time_keeps_the_book():
    for late, valid in ((45, 60), (45.001, 45)):
        s = Sampler(7, 45)
        s.event(as_dict(row(7, 0, 0, "snapshot")))
        s.event(as_dict(row(7, 1, late)))
        (m,) = s.until(us(60))
        assert seconds_of(m["valid_bitmap"]) == list(range(valid))


def test_time_alone_ends_minutes_and_starts_the_next():
    s = Sampler(7, 120)
    s.event(as_dict(row(7, 0, 0, "snapshot")))
    assert s.next_minute() * 1_000_000 == us(0)  # second 0 itself is still due
    got = [m for t in range(0, 300, 7) for m in s.until(us(t))]
    assert [seconds_of(m["valid_bitmap"]) for m in got] == [list(range(60)), list(range(60))] and s.next_minute() is None


def log_of(seed, length=260):
    """Three instruments: one falls silent for good, one pauses and comes back, one goes on."""
    rng, rows = random.Random(seed), []
    for instrument, pauses in ((1, [(70, 10_000)]), (2, [(95, 80), (200, 46)]), (3, [])):
        at, seq, fresh = 0.0, 0, True
        while at < length:
            for start, pause in pauses:
                if start <= at < start + 3:
                    at, fresh = at + pause, rng.random() < 0.7
            if at >= length:
                break
            bids, asks = [(100 - rng.randint(0, 5), rng.randint(0, 3))], [(102 + rng.randint(0, 5), rng.randint(1, 3))]
            rows.append(row(instrument, seq, at, "snapshot" if fresh or rng.random() < 0.05 else "update", bids=[(99, 1)] if fresh else [(p, q or 1) for p, q in bids], asks=asks))
            seq, at, fresh = seq + 1, at + rng.choice([0.3, 1.0, 2.7]), False
    return rows


def stored(spark, database):
    minutes = store.read(spark, database, "order_book_minute").orderBy("id").collect()
    deltas = store.read(spark, database, "order_book_second_delta").orderBy("minute_id", "second_offset").collect()
    return [tuple(m) for m in minutes], [tuple(d) for d in deltas]


def test_stream_with_silences_is_the_batch(spark, tmp_path, monkeypatch):
    log = spark.createDataFrame(log_of(5), schemas.BOOK_EVENT)
    last = log.agg(F.max("arrival_time")).first()[0]
    until = last - timedelta(seconds=10)  # the watermark's delay
    until = until.replace(microsecond=until.microsecond // 1000 * 1000)
    minutes, deltas = collect.minutes(log, F.lit(until))
    want = [tuple(r) for r in minutes.select(schemas.MINUTE.names).orderBy("id").collect()], [tuple(r) for r in deltas.select(schemas.DELTA.names).orderBy("minute_id", "second_offset").collect()]
    bits = {(r.instrument_id, int((r.minute_time - START).total_seconds()) // 60): seconds_of(r.valid_bitmap) for r in minutes.collect()}
    assert bits[3, 0] == bits[1, 0] == list(range(60)) and len(bits[1, 1]) in (54, 55, 56, 57, 58) and (1, 2) not in bits
    assert len(want[1]) > 100

    monkeypatch.setenv("TICKWEAVE_DATABASE", "outages")
    spark.sql("DROP DATABASE IF EXISTS outages CASCADE")
    source, seen = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for a, b in ((0, 65), (65, 118), (118, 10_000)):  # each run takes up where the last one stopped
        at = F.unix_micros("arrival_time") / 1e6 - us(0) / 1e6
        log.where((at >= a) & (at < b)).coalesce(1).write.mode("append").parquet(source)
        cli.main(["--collect", source, "--checkpoint", seen], spark)
    assert stored(spark, "outages") == want
    assert store.read(spark, "outages", "minute_quarantine").count() == 0


def test_events_behind_the_watermark_are_told(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TICKWEAVE_DATABASE", "late")
    spark.sql("DROP DATABASE IF EXISTS late CASCADE")
    source, seen = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    first = [row(1, 0, 0, "snapshot"), row(1, 1, 200)]
    spark.createDataFrame(first, schemas.BOOK_EVENT).coalesce(1).write.parquet(source)
    cli.main(["--collect", source, "--checkpoint", seen], spark)
    spark.createDataFrame([row(2, 0, 30, "snapshot"), row(2, 1, 201)], schemas.BOOK_EVENT).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(SystemExit, match="1 events"):
        cli.main(["--collect", source, "--checkpoint", seen], spark)


def test_a_broken_minute_stops_no_other(spark):
    spark.sql("DROP DATABASE IF EXISTS aside CASCADE")
    store.init(spark, "aside")
    samplers = {i: Sampler(i, 45) for i in (1, 2, 3)}
    out = []
    for i, s in samplers.items():
        s.event(as_dict(row(i, 0, 0, "snapshot")))
        s.event(as_dict(row(i, 1, 5, bids=[(100, 9)])))
        out += s.until(us(120))[:1]
    out[0]["valid_bitmap"] = 0b100001 & ~1  # no valid second 0
    out[2]["deltas"][0]["bid_change_prices"] = [-5]
    for m in out:
        m["minute_time"] = m["minute_time"].to_pydatetime()
    whole = spark.createDataFrame(out, streaming.WHOLE_MINUTE)
    for number in (1, 2):  # a batch that is run again
        assert store.write_sound_minutes(*streaming.split_minutes(whole), "aside", F.lit(number)) == 2
    minutes, deltas = stored(spark, "aside")
    assert [m[1] for m in minutes] == [2] and [d[0] & 0xFFFFFFFF for d in deltas] == [2]
    aside = store.read(spark, "aside", "minute_quarantine").orderBy(F.col("minute_id").bitwiseAND(0xFFFFFFFF)).collect()
    assert [(r.minute_id & 0xFFFFFFFF, r.rules) for r in aside] == [(1, ["anchor"]), (3, ["bid_prices"])]
    assert '"valid_bitmap":32' in aside[0].minute and "-5" in aside[1].deltas


class Handle:
    """A state store of dictionaries that counts what is written."""

    def __init__(self):
        self.values, self.writes = {}, 0

    def of(self, name, empty):
        handle = self

        class State:
            def exists(self):
                return name in handle.values

            def get(self):
                return handle.values[name] if empty is None else iter(handle.values.get(name, []))

            def update(self, value):
                handle.writes += 1
                handle.values[name] = value

            def clear(self):
                handle.values.pop(name, None)

            def appendValue(self, value):  # noqa: N802
                handle.writes += 1
                handle.values.setdefault(name, []).append(value)

            def iterator(self):
                return iter(list(handle.values.get(name, {}).items()))

            def updateValue(self, key, value):  # noqa: N802
                handle.writes += 1
                handle.values.setdefault(name, {})[key] = value

            def removeKey(self, key):  # noqa: N802
                handle.writes += 1
                del handle.values[name][key]

        return State()

    def getValueState(self, name, schema):  # noqa: N802
        assert isinstance(schema, T.StructType)
        return self.of(name, None)

    def getListState(self, name, schema):  # noqa: N802
        return self.of(name, [])

    def getMapState(self, name, key, value):  # noqa: N802
        return self.of(name, {})


def test_what_is_written_follows_what_changed():
    handle = Handle()
    state, feed = BookState(handle), Feed.of("Binance", "spot")
    snapshot = as_dict(row(1, 100, 0, "snapshot", bids=[(5000 - k, 1) for k in range(1000)], exchange="Binance"))
    snapshot["asks"] = [(6000 + k, Decimal(1)) for k in range(1000)]
    feed.apply(event_of(snapshot))
    state.load()
    state.save(feed, 1)
    assert handle.writes == 2001
    for n in range(1, 20):
        feed, conn = state.load()
        handle.writes = 0
        feed.apply(event_of(as_dict(row(1, 100 + n, n, bids=[(5000 - n, 7), (3000 + n, 2)], exchange="Binance", first=101 + n))))
        state.save(feed, conn)
        assert feed.last == 101 + n and handle.writes <= 5  # head, two levels set, one trimmed at the end
    again, _ = state.load()
    assert again.book.bids.qty == feed.book.bids.qty and len(again.book.bids.qty) == 1000 and again.book.complete == feed.book.complete
    handle.writes = 0
    state.save(Feed.of("Binance", "spot"), 2)  # another connection knows nothing
    assert handle.writes == 2001 and state.load()[0].book.bids.qty == {}


def test_a_sampler_in_the_state_is_the_sampler():
    """Loaded and saved after every event or not at all: the same minutes, early updates and deltas included."""
    rng, at, rows = random.Random(9), 0.0, []
    for n in range(240):
        at += rng.choice([0.5, 0.9])
        rows.append(row(1, n, at, exchange="Binance", prev=n, first=n, bids=[(80 + rng.randint(0, 21), rng.randint(0, 4))]))
    snapshot = row(1, 3, rows[3][5].timestamp() - START.timestamp(), "snapshot", exchange="Binance", bids=[(100, 1)])
    rows[3] = (*snapshot[:8], 2, *snapshot[9:])  # it lies before the last of the three updates that wait for it
    rows[4] = (*rows[4][:7], 4, 5, 3, *rows[4][10:])  # the update that the snapshot's place in the log took away
    plain, handle, out, again = Sampler(1, 45), Handle(), [], []
    for r in rows:
        out += plain.event(as_dict(r))
        state = SamplerState(handle, 45)
        sampler = state.load(1)
        again += sampler.event(as_dict(r))
        state.save(sampler)
    assert again == out and len(out) >= 1 and sum(len(m["deltas"]) for m in out) > 20
    state = SamplerState(handle, 45)
    sampler = state.load(1)
    assert state.is_due(us(10_000)) and sampler.until(us(10_000)) == plain.until(us(10_000))


def test_no_task_has_the_whole_log_of_an_instrument(spark, small, monkeypatch):
    for f in (ordering.previous, ordering.following):
        monkeypatch.setattr(f, "__defaults__", (64,))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log = projection.book_log(spark, small)
        for rows in (log, feeds.with_faults(log, next_time="next_time")):
            tasks = rows.where("instrument_id = 1").select("arrival_seq", "prev_id", *rows.columns[13:], F.spark_partition_id().alias("p")).distinct().select("p").distinct().count()
            assert tasks > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_books_are_replayed_once(spark):
    minutes, _ = collect.minutes(spark.createDataFrame(log_of(5), schemas.BOOK_EVENT), F.lit(START + timedelta(seconds=250)))
    plan = minutes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1
    assert "Relation" in plan and "LogicalRDD" not in plan and "LocalRelation" not in plan  # the log with its faults was worked out once, too


def test_seconds_where_time_falls_back(spark):
    times = [0, 1.5, 2.2, 0.5, 3]
    log = spark.createDataFrame([row(1, n, at, "update" if n else "snapshot") for n, at in enumerate(times)], schemas.BOOK_EVENT)
    got = sorted(r.second for r in collect.samples(log, F.lit(START + timedelta(seconds=5))).collect())
    assert got == [0, 1, 1, 2, 2, 3, 4, 5]  # what came at 2.2 ended before it began
