"""A book in a state store, level by level, and its samples by the second."""

from __future__ import annotations

import json
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from tickweave.operators.book import Book, Feed, Side, event_of
from tickweave.schemas import LOT, SIDES

_f = T.StructField
HEAD = T.StructType(
    [
        _f("conn_id", T.LongType()), _f("exchange", T.StringType()), _f("futures", T.BooleanType()), _f("retained", T.IntegerType()), _f("state", T.StringType()),
        _f("sequence", T.LongType()), _f("source_us", T.LongType()), _f("bids_whole", T.BooleanType()), _f("asks_whole", T.BooleanType()),
        _f("last", T.LongType()), _f("snapshot_seen", T.BooleanType()), _f("bridged", T.BooleanType()),
    ]
)
TEXT = T.StructType([_f("text", T.StringType())])
CLOCK = T.StructType([_f("due", T.LongType()), _f("last_us", T.LongType()), _f("minute", T.LongType()), _f("bitmap", T.LongType())])


def micros(time: Any) -> int | None:
    return None if time is None or pd.isna(time) else pd.Timestamp(time).value // 1000


def _time(us: int | None) -> pd.Timestamp | None:
    return None if us is None else pd.Timestamp(us, unit="us")


class BookState:
    """One feed: a few fields, a level for each price of a side, and the updates that wait for a snapshot.

    Saving writes the levels that differ from what was loaded and the updates
    that are new, so a batch writes what it changed and not the book.
    """

    def __init__(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", HEAD)
        self.sides = [handle.getMapState(n, T.StructType([_f("price", T.LongType())]), T.StructType([_f("qty", LOT)])) for n in ("bids", "asks")]
        self.early = handle.getListState("early", TEXT)
        self.loaded: list[dict[int, int]] = [{}, {}]
        self.waiting: list[dict] = []

    def load(self) -> tuple[Feed | None, int | None]:
        self.loaded, self.waiting = [{}, {}], []
        if not self.head.exists():
            return None, None
        conn, exchange, futures, retained, state, sequence, source, bids, asks, last, seen, bridged = self.head.get()
        self.loaded = [{k[0]: int(v[0]) for k, v in side.iterator()} for side in self.sides]
        if exchange != "OKX" and not seen:
            self.waiting = [self._read(x[0]) for x in self.early.get()]
        book = Book(retained, state, sequence, _time(source), Side(self.loaded[0]), Side(self.loaded[1]), [bids, asks])
        return Feed(exchange, futures, book, last, seen, bridged, list(self.waiting)), conn

    def save(self, feed: Feed, conn: int) -> None:
        b = feed.book
        self.head.update((conn, feed.exchange, feed.futures, b.retained, b.state, b.sequence, micros(b.source_time), *b.complete, feed.last, feed.snapshot_seen, feed.bridged))
        for side, was, now in zip(self.sides, self.loaded, (b.bids.qty, b.asks.qty), strict=True):
            for price in was.keys() - now.keys():
                side.removeKey((price,))
            for price, qty in now.items():
                if was.get(price) != qty:
                    side.updateValue((price,), (Decimal(qty),))
        kept = len(self.waiting)
        if feed.held[:kept] != self.waiting:
            self.early.clear()
            kept = 0
        for event in feed.held[kept:]:
            self.early.appendValue((self._text(event),))
        self.loaded, self.waiting = [dict(b.bids.qty), dict(b.asks.qty)], list(feed.held)

    @staticmethod
    def _text(e: dict) -> str:
        return json.dumps([e["first_id"], e["final_id"], e["prev_id"], micros(e["source_time"]), e["bids"], e["asks"]])

    @staticmethod
    def _read(text: str) -> dict:
        first, final, prev, source, bids, asks = json.loads(text)
        return {"kind": "update", "first_id": first, "final_id": final, "prev_id": prev, "source_time": _time(source), "bids": [tuple(x) for x in bids], "asks": [tuple(x) for x in asks]}


def waits(event: dict) -> dict:
    """What of an event is kept while it waits: the same whether it was read from the state or not."""
    return BookState._read(BookState._text(event))


class Minute:
    """One minute of samples as it fills: an anchor at second 0, then what differs from the last valid second."""

    def __init__(self, number: int, bitmap: int = 0, anchor: list | None = None, deltas: list | None = None) -> None:
        self.number, self.bitmap, self.anchor, self.deltas = number, bitmap, anchor, deltas or []
        self.last = anchor
        for _, *sides in self.deltas:
            self.last = [self._changed(levels, rows, down) for levels, rows, down in zip(self.last, sides, (True, False), strict=True)]

    @staticmethod
    def _changed(levels: list, rows: list, down: bool) -> list:
        held = dict(map(tuple, levels)) | dict(map(tuple, rows))
        return [[p, held[p]] for p in sorted(held, reverse=down) if held[p]]

    def sample(self, second: int, top: list) -> None:
        """A valid second's best levels; without a valid second 0 nothing is kept."""
        if self.anchor is None and second > 0:
            return
        self.bitmap |= 1 << second
        if self.anchor is None:
            self.anchor = top
        elif top != self.last:
            sides = []
            for old, new, down in zip(self.last, top, (True, False), strict=True):
                was, now = dict(map(tuple, old)), dict(map(tuple, new))
                changed = sorted((p for p in was.keys() | now.keys() if was.get(p) != now.get(p)), reverse=down)
                sides.append([[p, now.get(p, 0)] for p in changed])
            self.deltas.append([second, *sides])
        self.last = top

    def row(self, instrument: int) -> dict:
        names = [f"{s}_{n}" for s in SIDES for n in ("prices", "qtys")]
        flat = lambda sides: [x for side in sides for x in ([p for p, _ in side], [Decimal(q) for _, q in side])]
        time = pd.Timestamp(self.number * 60, unit="s")
        deltas = [{"second_offset": s} | dict(zip([n.replace("_", "_change_", 1) for n in names], flat(sides), strict=True)) for s, *sides in self.deltas]
        head = {"id": self.number << 32 | instrument, "instrument_id": instrument, "minute_time": time, "valid_bitmap": self.bitmap}
        return head | dict(zip(names, flat(self.anchor), strict=True)) | {"deltas": deltas}


class Sampler:
    """A feed sampled at whole seconds of arrival time: a second has the state after the last event at or before it.

    A feed that is silent for longer than ``silence`` seconds is broken from
    then on, whether or not anything follows: its book is invalid until a new
    snapshot.  Seconds without a valid book cost nothing, however many they are.
    """

    def __init__(self, instrument: int, silence: int, feed: Feed | None = None, conn: int | None = None, due: int | None = None, last_us: int | None = None, minute: Minute | None = None) -> None:
        self.instrument, self.silence = instrument, silence * 1_000_000
        self.feed, self.conn, self.due, self.last_us, self.minute = feed, conn, due, last_us, minute

    def event(self, row: dict) -> list[dict]:
        """Handles one event of the log, after the seconds before it; returns minutes that are over."""
        at = micros(row["arrival_time"])
        out = self._seconds(-(-at // 1_000_000), self.last_us is not None and at > self.last_us + self.silence)
        self.last_us = at if self.last_us is None else max(at, self.last_us)
        if self.feed is None or row["conn_id"] != self.conn:
            self.feed, self.conn = Feed.of(row["exchange"], row["market_type"]), int(row["conn_id"])
        event = event_of(row)
        self.feed.apply(event)
        if self.feed.held and self.feed.held[-1] is event:
            self.feed.held[-1] = waits(event)
        return out

    def until(self, us: int) -> list[dict]:
        """Nothing more will arrive up to this time, itself included; returns minutes that are over."""
        if self.feed is None:
            return []
        return self._seconds(us // 1_000_000 + 1, us >= self.last_us + self.silence)

    def next_minute(self) -> int | None:
        """The second at which the minute under way ends, or None if time alone changes nothing."""
        if self.feed is None or not (self.feed.book.top(1) or self.minute is not None and self.minute.anchor is not None):
            return None
        return -(-self.due // 60) * 60

    def _seconds(self, stop: int, silent: bool) -> list[dict]:
        if self.due is None:
            self.due = stop
            return []
        out = []
        if silent:
            out = self._hold(min(stop, -(-(self.last_us + self.silence) // 1_000_000)))
            self.feed.apply({"kind": "invalidate"})
        return out + self._hold(stop)

    def _hold(self, stop: int) -> list[dict]:
        """Samples the seconds that are due before ``stop``, all with the book as it is."""
        out, top = [], self.feed.book.top() if stop > self.due else None
        if top is not None:
            top = [[list(x) for x in side] for side in top]
            for s in range(self.due, stop):
                if self.minute is None or self.minute.number != s // 60:
                    out += self._close()
                    self.minute = Minute(s // 60)
                self.minute.sample(s % 60, top)
        elif self.minute is not None and stop > self.due and (stop - 1) // 60 > self.minute.number:
            out += self._close()
        self.due = max(self.due, stop)
        return out

    def _close(self) -> list[dict]:
        minute, self.minute = self.minute, None
        return [minute.row(self.instrument)] if minute is not None and minute.anchor is not None else []


class SamplerState:
    """A sampler in a state store: its feed, its clock, and the minute under way, to which deltas are appended."""

    def __init__(self, handle: StatefulProcessorHandle, silence: int) -> None:
        self.book, self.silence = BookState(handle), silence
        self.clock = handle.getValueState("clock", CLOCK)
        self.anchor = handle.getValueState("anchor", TEXT)
        self.deltas = handle.getListState("deltas", TEXT)
        self.kept: tuple[int | None, int] = (None, 0)

    def is_due(self, us: int) -> bool:
        """Whether time alone has anything to do up to then."""
        return self.clock.exists() and us // 1_000_000 + 1 > self.clock.get()[0]

    def load(self, instrument: int) -> Sampler:
        if not self.clock.exists():
            self.kept = (None, 0)
            return Sampler(instrument, self.silence)
        due, last_us, number, bitmap = self.clock.get()
        minute = None
        if number is not None:
            anchor = json.loads(self.anchor.get()[0]) if self.anchor.exists() else None
            minute = Minute(number, bitmap, anchor, [json.loads(x[0]) for x in self.deltas.get()] if anchor is not None else None)
        self.kept = (None, 0) if minute is None or minute.anchor is None else (number, len(minute.deltas))
        return Sampler(instrument, self.silence, *self.book.load(), due, last_us, minute)

    def save(self, sampler: Sampler) -> None:
        if sampler.feed is None:
            return
        self.book.save(sampler.feed, sampler.conn)
        minute = sampler.minute
        self.clock.update((sampler.due, sampler.last_us, *((None, None) if minute is None else (minute.number, minute.bitmap))))
        number, kept = self.kept
        if minute is None or minute.anchor is None:
            if number is not None:
                self.anchor.clear()
                self.deltas.clear()
            return
        if minute.number != number:
            self.anchor.update((json.dumps(minute.anchor),))
            self.deltas.clear()
            kept = 0
        for delta in minute.deltas[kept:]:
            self.deltas.appendValue((json.dumps(delta),))
