"""Books as sorted sides with an undo list, and logs replayed in segments, against plain versions."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweave import schemas
from tickweave.operators import book, ordering
from tickweave.operators.book import Book, BookError, Feed, Side

T0 = datetime(2026, 1, 1)


class Plain:
    """A book of two dictionaries, copied and sorted at each change."""

    def __init__(self, retained, bids, asks):
        self.retained, self.sides, self.valid = retained, [dict(bids), dict(asks)], True
        self.complete = [len(bids) < retained, len(asks) < retained]

    def change(self, *changes):
        if not self.valid:
            raise BookError
        new = []
        for side, rows in zip(self.sides, changes, strict=True):
            side = dict(side)
            for p, q in rows:
                side[p] = q
            new.append({p: q for p, q in side.items() if q})
        if new[0] and new[1] and max(new[0]) >= min(new[1]):
            raise BookError
        for k, side in enumerate(new):
            kept = sorted(side, reverse=k == 0)[: self.retained]
            self.complete[k] &= len(kept) == len(side)
            new[k] = {p: side[p] for p in kept}
        self.sides = new
        self.valid = not any(len(s) < schemas.DEPTH and not c for s, c in zip(new, self.complete, strict=True))

    def top(self):
        if not self.valid or not all(self.sides):
            return None
        return sorted(self.sides[0].items(), reverse=True)[: schemas.DEPTH], sorted(self.sides[1].items())[: schemas.DEPTH]


LEVELS = st.lists(st.tuples(st.integers(1, 140), st.integers(0, 3)), max_size=6, unique_by=lambda x: x[0])


@settings(max_examples=150, deadline=None)
@given(st.integers(50, 64), st.lists(st.tuples(LEVELS, LEVELS), max_size=25))
def test_sorted_sides_are_as_copied_dictionaries(retained, changes):
    start = [(60 - i, 1 + i) for i in range(52)], [(80 + i, 1 + i) for i in range(min(55, retained))]
    fast = Book(retained)
    fast.apply_snapshot(1, T0, start[0][:retained], start[1])
    plain = Plain(retained, start[0][:retained], start[1])
    for n, (bids, asks) in enumerate(changes):
        failed = []
        for act in (lambda: fast.apply_changes(fast.sequence, n + 2, T0, bids, asks), lambda: plain.change(bids, asks)):
            try:
                act()
                failed.append(False)
            except BookError:
                failed.append(True)
        assert failed[0] == failed[1] and fast.top() == plain.top()
        assert fast.bids.qty == plain.sides[0] and fast.asks.qty == plain.sides[1]
        assert fast.bids.prices == sorted(fast.bids.qty) and fast.asks.prices == sorted(fast.asks.qty)


def test_an_update_costs_the_same_whatever_is_retained():
    def cost(levels):
        b = Book(100_000)
        b.apply_snapshot(1, T0, [(1_000_000 - i, 1) for i in range(levels)], [(2_000_000 + i, 1) for i in range(levels)])
        best = []
        for _ in range(5):
            began, n = time.perf_counter(), b.sequence
            for k in range(2_000):
                b.apply_changes(n + k, n + k + 1, T0, [(1_000_000 - k % 50, 1 + k % 7)], [])
                b.top(5)
            best.append(time.perf_counter() - began)
        return min(best)

    assert cost(10_000) < 3 * cost(100)  # a hundred times the levels; copies and sorts would make it 50 times as dear


def test_levels_of_a_side():
    s = Side([(5, 1), (7, 2)])
    assert s.set(5, 0) == 1 and s.set(6, 3) == 0 and s.set(5, 0) == 0
    assert s.best(2, True) == [(7, 2), (6, 3)] and s.best(1, False) == [(6, 3)]


def random_log(seed, instruments, length):
    """Logs of both exchanges with snapshots, bad snapshots, gaps, resets, crossings, faults, new connections and early updates."""
    rng, rows = random.Random(seed), []
    for instrument in range(1, instruments + 1):
        exchange, market = [("OKX", "perpetual"), ("Binance", "spot"), ("Binance", "perpetual")][instrument % 3]
        conn, last = 1, rng.randint(10, 20)
        for seq in range(length):
            kind, first, prev, dice = "update", None, None, rng.random()
            bids = [(100 - rng.randint(0, 9), rng.randint(0, 3))]
            asks = [(101 + rng.randint(0, 9), rng.randint(0, 3))] if rng.random() < 0.5 else []
            if dice < 0.06 or seq == 3:
                kind, bids, asks = "snapshot", [(100 - k, 1) for k in range(rng.randint(1, 4))], [(101 + k, 1) for k in range(rng.randint(0, 4))]
                if rng.random() < 0.3:
                    asks = [(90, 1)]  # crossed: refused
                last, prev = last + rng.randint(-2, 5), -1
                final = last
            else:
                final = last + rng.randint(1, 3)
                first, prev = last + 1, last
                if dice < 0.10:
                    first, prev = last + 3, last + 2  # a gap
                elif dice < 0.13:
                    final = last - 2
                elif dice < 0.16:
                    bids = [(109, 1)]  # crossed with what is likely there
                elif dice < 0.18:
                    kind = "invalidate"
                elif dice < 0.19:
                    conn += 1
                last = max(last, final)
            rows.append((instrument, exchange, market, conn, seq * 1000, T0 + timedelta(seconds=seq), kind, first, final, prev, T0, [(p, Decimal(q)) for p, q in bids], [(p, Decimal(q)) for p, q in asks]))
    return rows


def test_segments_are_the_single_run(spark):
    rows = random_log(11, 3, 600)
    log = spark.createDataFrame(rows, schemas.BOOK_EVENT)
    want, feed, at = [], None, None
    for r in log.orderBy("instrument_id", "arrival_seq").collect():
        if (r.instrument_id, r.conn_id) != at:
            feed, at = Feed.of(r.exchange, r.market_type), (r.instrument_id, r.conn_id)
        e = book.event_of(r.asDict())
        v = book.view(feed, e, feed.apply(e))
        want.append(tuple(v[c] for c in book.VIEW.names))
    got = [tuple(r) for r in book.replay_log(log).orderBy("instrument_id", "arrival_seq").collect()]
    assert got == want
    assert {r[5] for r in want} >= {None, "gap", "crossed", "crossed snapshot", "no snapshot yet", "invalidate", "sequence reset"}
    cut = book.segments(log)
    per = cut.groupBy("instrument_id").agg(F.count_distinct("conn_id", "segment").alias("n")).collect()
    assert all(r.n > 5 for r in per)
    busy = book.replay_log(log).select(F.spark_partition_id().alias("p")).distinct().count()
    assert busy > 3  # one instrument's log is the work of several tasks


def test_running_counts_over_ranges(spark):
    rng = random.Random(2)
    rows = [(k, n, rng.random() < 0.4) for k in range(3) for n in sorted(rng.sample(range(5_000), 300))]
    df = spark.createDataFrame(rows, "k int, n int, hit boolean").repartition(7)
    got = {(r.k, r.n): r.c for r in ordering.running_count(df, ["k"], "n", F.col("hit"), "c", width=64).collect()}
    count: dict[int, int] = {}
    for k, n, hit in rows:
        count[k] = count.get(k, 0) + hit
        assert got[k, n] == count[k]


def test_too_many_early_updates_invalidate():
    f = Feed.of("Binance", "spot")
    e = {"kind": "update", "first_id": 1, "final_id": 2, "prev_id": None, "source_time": T0, "bids": [(1, 1)], "asks": []}
    reasons = [f.apply(e) for _ in range(book.EARLY + 2)]
    assert set(reasons[: book.EARLY]) == {"insufficient retained depth"} and reasons[book.EARLY] == "too many updates before the snapshot" and reasons[-1] == "no snapshot yet"
    assert f.held == [] and f.book.state == book.INVALID


def log_of(spark, exchange, market_type, faults, n=400):
    """A snapshot and n updates of one instrument, some of them broken, as rows and as what one feed makes of them in one go."""
    rng = random.Random(f"{exchange}{market_type}{faults}")
    rows, last = [], 10
    for k in range(n):
        first, final, before = last + 1, last + 2, last
        kind, bids, asks = "update", [], []
        if k in (0, 250):
            kind, bids, asks = "snapshot", [(90, 1), (80, 2)], [(110, 1), (120, 2)]
        elif k in faults:
            bids = {"cross": [(300, 1)], "gap": [(85, 1)], "none": []}[faults[k]]
            before, first = (last + 5, last + 6) if faults[k] == "gap" else (before, first)
            final = first + 1
        elif rng.random() < 0.5:
            bids = [(rng.randint(60, 99), rng.randint(0, 3))]
        else:
            asks = [(rng.randint(101, 140), rng.randint(0, 3)), (rng.randint(141, 150), 0)]
        if k in (1, 251) and exchange != "OKX" and market_type != "spot":
            first = last
        time_ = T0 + timedelta(milliseconds=300 * k)
        rows.append((1, exchange, market_type, 1, 3 * k + 7, time_, kind, first, final, before, time_, *([(p, Decimal(q)) for p, q in side] for side in (bids, asks))))
        last = final
    feed = Feed.of(exchange, market_type)
    want = []
    for row in rows:
        event = book.event_of(dict(zip(schemas.BOOK_EVENT.names, row, strict=True)))
        want.append(book.view(feed, event, feed.apply(event)))
    return spark.createDataFrame(rows, schemas.BOOK_EVENT), want


def test_long_segments_are_dealt_to_stretches_with_the_same_views(spark, monkeypatch):
    monkeypatch.setattr(book.stretches, "__defaults__", (64,))
    cases = (("OKX", "perpetual", {}), ("Binance", "perpetual", {22: "gap", 330: "cross"}), ("Binance", "spot", {101: "cross"}))
    for exchange, market_type, faults in cases:
        log, want = log_of(spark, exchange, market_type, faults)
        got = sorted((r.asDict() for r in book.replay_log(log).collect()), key=lambda r: r["arrival_seq"])
        assert got == want
        dealt = book.stretches(book.segments(log)).select("segment", "stretch").distinct().count()
        assert dealt >= 19 if not faults else 2 < dealt < 19


def test_a_stretch_may_begin_after_the_snapshot_alone(spark, monkeypatch):
    monkeypatch.setattr(book.stretches, "__defaults__", (10,))  # the snapshot has number 7, the next rows 10 and 13
    log, want = log_of(spark, "Binance", "spot", {1: "gap"}, 30)
    got = sorted((r.asDict() for r in book.replay_log(log).collect()), key=lambda r: r["arrival_seq"])
    assert got == want and want[1]["reason"] == "the first update does not bridge the snapshot"


def test_following_over_ranges(spark):
    rng = random.Random(4)
    rows = [(k, n, rng.choice([None, rng.randint(0, 99)])) for k in range(3) for n in sorted(rng.sample(range(5_000), 200))]
    df = spark.createDataFrame(rows, "k int, n int, v int").repartition(7)
    got = {(r.k, r.n): r.f for r in ordering.following(df, ["k"], "n", "v", "f", width=64).collect()}
    assert got == {(k, n): rows[i + 1][2] if i + 1 < len(rows) and rows[i + 1][0] == k else None for i, (k, n, _) in enumerate(rows)}


def one_run(rows):
    """What a feed for each connection makes of rows of a log, in one go."""
    want, feed, at = [], None, None
    for row in rows:
        event = book.event_of(dict(zip(schemas.BOOK_EVENT.names, row, strict=True)))
        if (event["instrument_id"], event["conn_id"]) != at:
            feed, at = Feed.of(event["exchange"], event["market_type"]), (event["instrument_id"], event["conn_id"])
        want.append(book.view(feed, event, feed.apply(event)))
    return want


def test_a_book_that_waits_is_the_work_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(book.stretches, "__defaults__", (64,))
    for exchange, market_type, first in (("OKX", "perpetual", "snapshot"), ("OKX", "spot", "update"), ("Binance", "spot", "snapshot")):
        rows = []
        for k in range(400):
            kind = {0: first, 100: "invalidate", 200: "resync", 300: "snapshot"}.get(k, "update")
            asks = [(90, 1)] if k == 300 else [(110 + k % 9, 1)] if kind == "snapshot" else []  # the second snapshot is crossed
            none = kind in ("invalidate", "resync")
            rows.append((1, exchange, market_type, 1, 3 * k + 7, T0 + timedelta(seconds=k), kind, *([None] * 4 if none else [k, k + 1, k, T0]), *([None] * 2 if none else [[(100 - k % 9, Decimal(1))], [(p, Decimal(q)) for p, q in asks]])))
        log = spark.createDataFrame(rows, schemas.BOOK_EVENT)
        got = sorted((r.asDict() for r in book.replay_log(log).collect()), key=lambda r: r["arrival_seq"])
        assert got == one_run(rows)
        assert {r["state"] for r in got[1:]} >= {"invalid", "resyncing", "valid" if first == "snapshot" else "connecting"}
        assert book.stretches(book.segments(log)).select("segment", "stretch").distinct().count() >= 19


def test_short_stretches_are_the_single_run(spark, monkeypatch):
    monkeypatch.setattr(book.stretches, "__defaults__", (4000,))  # four rows
    rows = [(*r[:6], "resync" if r[6] == "invalidate" and r[4] % 2000 else r[6], *r[7:]) for r in random_log(12, 6, 250)]
    got = sorted((r.asDict() for r in book.replay_log(spark.createDataFrame(rows, schemas.BOOK_EVENT)).collect()), key=lambda r: (r["instrument_id"], r["arrival_seq"]))
    assert got == one_run(rows)
