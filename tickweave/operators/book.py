"""Level-2 books from event logs: the rules of one book, the same over a batch, and set-based twins.

What a book does depends on the order of its updates (a crossed update is
undone, levels beyond the retained depth are lost), so the truth is kept by one
small state machine for each instrument, fed in order by Spark.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickweave.operators.ordering import previous, running_count
from tickweave.schemas import DEPTH, RETAINED

CONNECTING, VALID, INVALID, RESYNCING = "connecting", "valid", "invalid", "resyncing"
#: Updates that wait for a connection's first snapshot at most.
EARLY = 4096
#: Kind of the rows that stand for what a book held when a stretch began, and values of the order that a stretch spans.
HELD, STRETCH = "held", 1 << 16
#: Kinds that make a book wait for a snapshot, and its state then; such a state is also the kind of a row that a stretch of a waiting book begins with.
SHUT = {"invalidate": INVALID, "resync": RESYNCING}


class BookError(ValueError):
    """An update that may not be applied; the book is as before it."""


class Side:
    """One side of a book: quantities by price, and the prices in order, so the best and the worst are at hand.

    A change costs a binary search and a shift of the array; nothing is copied
    or sorted.
    """

    __slots__ = ("prices", "qty")

    def __init__(self, levels: Iterable[tuple[int, int]] | dict[int, int] = ()) -> None:
        self.qty = dict(levels)
        self.prices = sorted(self.qty)

    def __len__(self) -> int:
        return len(self.prices)

    def set(self, price: int, qty: int) -> int:
        """Sets an absolute quantity, 0 deleting; returns what it was, 0 if nothing."""
        old = self.qty.get(price, 0)
        if qty:
            self.qty[price] = qty
            if not old:
                insort(self.prices, price)
        elif old:
            del self.qty[price]
            del self.prices[bisect_left(self.prices, price)]
        return old

    def best(self, depth: int, highest: bool) -> list[tuple[int, int]]:
        prices = self.prices[: -depth - 1 : -1] if highest else self.prices[:depth]
        return [(p, self.qty[p]) for p in prices]


@dataclass
class Book:
    retained: int
    state: str = CONNECTING
    sequence: int = 0
    source_time: Any = None
    bids: Side = field(default_factory=Side)
    asks: Side = field(default_factory=Side)
    complete: list[bool] = field(default_factory=lambda: [False, False])

    def __post_init__(self) -> None:
        if self.retained < DEPTH:
            raise BookError(f"retained depth {self.retained} is less than {DEPTH}")

    def apply_snapshot(self, sequence: int, source_time: Any, bids: list[tuple[int, int]], asks: list[tuple[int, int]]) -> None:
        """Replaces both sides; a side shorter than the retained depth is known whole."""
        for rows in (bids, asks):
            if not 1 <= len(rows) <= self.retained or any(p <= 0 or q <= 0 for p, q in rows) or len({p for p, _ in rows}) != len(rows):
                raise BookError("bad snapshot")
        if max(p for p, _ in bids) >= min(p for p, _ in asks):
            raise BookError("crossed snapshot")
        self.bids, self.asks = Side(bids), Side(asks)
        self.complete = [len(bids) < self.retained, len(asks) < self.retained]
        self.state, self.sequence, self.source_time = VALID, sequence, source_time

    def crossed(self) -> bool:
        """Whether the best bid reaches the best ask; a side without levels crosses nothing."""
        return bool(self.bids.prices and self.asks.prices) and self.bids.prices[-1] >= self.asks.prices[0]

    def apply_changes(self, expected: int, sequence: int, source_time: Any, bids: list[tuple[int, int]], asks: list[tuple[int, int]]) -> None:
        """Sets absolute quantities, 0 deleting.  Too few known levels make the book invalid, which is no error.

        What was there before goes to a list, from which a change that crosses
        the book is undone.
        """
        if source_time is None or sequence <= expected:
            raise BookError("no source time, or a sequence that doesn't grow")
        for rows in (bids, asks):
            if any(p <= 0 or q < 0 for p, q in rows) or len({p for p, _ in rows}) != len(rows):
                raise BookError("bad change")
        if self.state != VALID or self.sequence != expected:
            raise BookError("the book is not at the expected sequence")
        undo = [(side, price, side.set(price, qty)) for side, rows in ((self.bids, bids), (self.asks, asks)) for price, qty in rows]
        if self.crossed():
            for side, price, qty in reversed(undo):
                side.set(price, qty)
            raise BookError("crossed")
        for k, side in enumerate((self.bids, self.asks)):
            while len(side) > self.retained:
                side.set(side.prices[0] if k == 0 else side.prices[-1], 0)
                self.complete[k] = False
        if any(len(side) < DEPTH and not whole for side, whole in zip((self.bids, self.asks), self.complete, strict=True)):
            self.state = INVALID
            return
        self.sequence, self.source_time = sequence, source_time

    def top(self, depth: int = DEPTH) -> tuple[list[tuple[int, int]], list[tuple[int, int]]] | None:
        """The best levels of both sides, if the book is valid and neither is empty."""
        if self.state != VALID or not self.bids.prices or not self.asks.prices:
            return None
        return self.bids.best(depth, True), self.asks.best(depth, False)


@dataclass
class Feed:
    """A book behind an exchange's rules of continuity; ``error`` tells why it last became invalid."""

    exchange: str
    futures: bool
    book: Book
    last: int = 0
    snapshot_seen: bool = False
    bridged: bool = False
    held: list[dict] = field(default_factory=list)

    @classmethod
    def of(cls, exchange: str, market_type: str) -> Feed:
        return cls(exchange, market_type != "spot", Book(RETAINED.get(exchange, DEPTH)))

    def resume(self, e: dict) -> None:
        """Goes on from a valid book that is known whole, ``first_id`` telling whether updates came after its snapshot, or from one that waits for a snapshot."""
        if e["kind"] != HELD:
            self.book.state, self.book.sequence = e["kind"], e["final_id"]
            return
        self.book.bids, self.book.asks, self.book.complete = Side(e["bids"]), Side(e["asks"]), [True, True]
        self.book.state, self.book.sequence, self.book.source_time = VALID, e["final_id"], e["source_time"]
        self.last, self.snapshot_seen, self.bridged = e["final_id"], True, bool(e["first_id"])

    def apply(self, event: dict) -> str | None:
        """Handles one event of the log; returns the reason if it made or found the book unusable."""
        kind = event["kind"]
        if kind in SHUT:
            self.book.state = SHUT[kind]
            self.snapshot_seen, self.held = False, []
            return kind
        try:
            if kind == "snapshot":
                self._snapshot(event)
            elif self.exchange == "OKX":
                self._okx(event)
            else:
                self._binance(event)
        except BookError as error:
            return str(error)
        return None if self.book.state == VALID else "insufficient retained depth"

    def _snapshot(self, e: dict) -> None:
        self.book.apply_snapshot(e["final_id"], e["source_time"], e["bids"], e["asks"])
        self.last, self.snapshot_seen, self.bridged = e["final_id"], True, False
        waiting, self.held = self.held, []
        for early in waiting:  # updates that arrived while the snapshot was asked for
            self._binance(early)

    def _broken(self, why: str) -> BookError:
        self.book.state, self.snapshot_seen = INVALID, False
        return BookError(why)

    def _changes(self, sequence: int, e: dict) -> None:
        try:
            self.book.apply_changes(self.book.sequence, sequence, e["source_time"], e["bids"], e["asks"])
        except BookError as error:
            raise self._broken(str(error)) from error
        if self.book.state != VALID:
            raise self._broken("insufficient retained depth")
        self.last = sequence

    def _binance(self, e: dict) -> None:
        first, final, before = e["first_id"], e["final_id"], e["prev_id"]
        if not self.snapshot_seen:
            if self.book.state == CONNECTING:
                if len(self.held) == EARLY:  # dropping any of them would leave a gap
                    self.held = []
                    raise self._broken("too many updates before the snapshot")
                self.held.append(e)
                return
            raise BookError("no snapshot yet")
        if final <= self.last:
            return
        if not self.bridged:
            bridge = self.last if self.futures else self.last + 1
            if not first <= bridge <= final:
                raise self._broken("the first update does not bridge the snapshot")
        elif self.futures and before != self.last or not self.futures and first > self.last + 1:
            raise self._broken("gap")
        self.bridged = True
        self._changes(final, e)

    def _okx(self, e: dict) -> None:
        sequence, before = e["final_id"], e["prev_id"]
        if not self.snapshot_seen:
            raise BookError("no snapshot yet")
        if sequence < before:
            raise self._broken("sequence reset")
        if not e["bids"] and not e["asks"] and before == sequence == self.last:
            return
        if sequence <= self.last:
            return
        if before != self.last or sequence <= before:
            raise self._broken("gap")
        self._changes(sequence, e)


def pairs(levels: Any) -> list[tuple[int, int]]:
    """Levels as they come from Spark, by row or by struct, as pairs."""
    if levels is None:
        return []
    return [(int(x["price"]), int(x["qty"])) if isinstance(x, dict) else (int(x[0]), int(x[1])) for x in levels]


VIEW = T.StructType(
    [
        T.StructField("instrument_id", T.LongType()), T.StructField("arrival_seq", T.LongType()), T.StructField("arrival_time", T.TimestampType()),
        T.StructField("state", T.StringType()), T.StructField("sequence", T.LongType()), T.StructField("reason", T.StringType()),
        *[T.StructField(f"{s}_{n}", T.ArrayType(T.LongType())) for s in ("bid", "ask") for n in ("prices", "qtys")],
    ]
)


def view(feed: Feed, event: dict, reason: str | None, depth: int = DEPTH) -> dict:
    """What the book looks like after an event: its state and, where it is valid, its best levels."""
    bids, asks = feed.book.top(depth) or ([], [])
    return {
        "instrument_id": event["instrument_id"], "arrival_seq": event["arrival_seq"], "arrival_time": event["arrival_time"],
        "state": feed.book.state, "sequence": feed.book.sequence, "reason": reason,
        "bid_prices": [p for p, _ in bids], "bid_qtys": [q for _, q in bids], "ask_prices": [p for p, _ in asks], "ask_qtys": [q for _, q in asks],
    }


def event_of(row: dict) -> dict:
    whole = {k: (None if row[k] is None or pd.isna(row[k]) else int(row[k])) for k in ("first_id", "final_id", "prev_id")}
    time = row["source_time"]
    return row | whole | {"source_time": None if time is None or pd.isna(time) else time, "bids": pairs(row["bids"]), "asks": pairs(row["asks"])}


def _retained() -> Column:
    found = F.lit(DEPTH)
    for exchange, depth in RETAINED.items():
        found = F.when(F.col("exchange") == exchange, depth).otherwise(found)
    return found


def segments(events: DataFrame) -> DataFrame:
    """The log with ``segment``: how many snapshots had replaced the book of its connection by then, without the first but on OKX.

    A snapshot that is taken replaces all that a feed knows, so what follows it
    can be replayed without what was before.  Not so the first of a connection,
    which lets in the updates that waited for it (on OKX none do), and one that
    breaks a rule, which changes nothing.
    """
    retained = _retained()
    good = F.lit(True)
    for side in ("bids", "asks"):
        levels, prices = F.col(side), F.transform(side, lambda x: x.price)
        good &= F.size(levels).between(1, retained) & F.forall(side, lambda x: (x.price > 0) & (x.qty > 0)) & (F.size(F.array_distinct(prices)) == F.size(prices))
    good &= F.array_max(F.transform("bids", lambda x: x.price)) < F.array_min(F.transform("asks", lambda x: x.price))
    taken = F.coalesce((F.col("kind") == "snapshot") & good, F.lit(False))
    counted = running_count(events, ["instrument_id", "conn_id"], "arrival_seq", taken, "segment")
    return counted.withColumn("segment", F.when(F.col("exchange") == "OKX", F.col("segment")).otherwise(F.greatest(F.col("segment") - 1, F.lit(0))))


def _good_levels(side: str, least: int) -> Column:
    """Prices above 0, each once, and quantities of ``least`` and more."""
    prices = F.transform(side, lambda x: x.price)
    return F.forall(side, lambda x: (x.price > 0) & (x.qty >= least)) & (F.size(F.array_distinct(prices)) == F.size(prices))


def stretches(events: DataFrame, width: int = STRETCH) -> DataFrame:
    """Segments with ``stretch``, parts that can be replayed apart, each but the first led by a row of what the book held then.

    In a segment that begins with a snapshot that is taken, a part is sound if
    its updates follow each other without a break and can't cross or trim the
    book: all bids ever set in the segment up to its end are below all asks,
    and their prices are fewer than the retained depth.  The book is then the
    last quantity of each price.  Parts up to the first that isn't sound are
    replayed apart; that one and what follows it are one sequence, unless the
    first row that isn't sound makes the book wait for a snapshot.  There is
    none in the rest of the segment then, whose parts are replayed apart, too;
    and so are those of updates that no snapshot came before on OKX.
    """
    keys = ["instrument_id", "conn_id", "segment"]
    lines = [*keys, "stretch"]
    rows = events.withColumn("stretch", F.floor(F.col("arrival_seq") / width).cast("long"))
    chain = previous(rows.withColumn("__now__", F.struct("final_id", "kind")), keys, "arrival_seq", "__now__", "__before__", width)
    head, after, last_id = F.col("__before__").isNull(), F.col("__before__.kind") == "snapshot", F.col("__before__.final_id")
    chained, futures, retained = F.col("exchange") == "OKX", F.col("market_type") != "spot", _retained()
    whole = lambda side: F.size(side).between(1, retained - 1) & _good_levels(side, 1)
    first = head & (F.col("kind") == "snapshot") & whole("bids") & whole("asks")
    follows = F.when(chained | futures & ~after, F.col("prev_id") == last_id).when(futures, F.col("first_id") <= last_id).otherwise(F.col("first_id") <= last_id + 1)
    update = ~head & (F.col("kind") == "update") & (F.col("final_id") > last_id) & follows & F.col("source_time").isNotNull() & _good_levels("bids", 0) & _good_levels("asks", 0)
    marked = chain.withColumn("__sound__", F.coalesce(first | update, F.lit(False)))

    ahead = Window.partitionBy(*keys).orderBy("stretch")
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    unsound, shut = F.when(~F.col("__sound__"), F.col("arrival_seq")), F.when(F.col("kind").isin(*SHUT), F.col("arrival_seq"))
    state = F.coalesce(*(F.when(F.col("kind") == kind, state) for kind, state in SHUT.items()))
    parts = marked.groupBy(*lines).agg(
        F.bool_and("__sound__").alias("sound"), F.min_by(F.struct("kind", last_id.alias("last_id")), unsound).alias("broke"), F.max_by(state, shut).alias("shut"),
        F.max_by(F.struct("arrival_seq", "arrival_time", "exchange", "market_type", "final_id", "source_time", "kind"), "arrival_seq").alias("end"), F.max(retained).alias("retained"),
    )
    each = lambda side: rows.select(*lines, "arrival_seq", F.lit(side).alias("side"), F.inline(side))
    last = each("bids").unionByName(each("asks")).groupBy(*lines, "side", "price").agg(F.max_by("qty", "arrival_seq").alias("qty"), F.bool_or(F.col("qty") > 0).alias("set"))
    fresh = last.withColumn("n", (F.row_number().over(Window.partitionBy(*keys, "side", "price").orderBy("stretch")) == 1).cast("long"))
    spans = fresh.groupBy(*lines).agg(
        F.max(F.when((F.col("side") == "bids") & F.col("set"), F.col("price"))).alias("bid"), F.min(F.when((F.col("side") == "asks") & F.col("set"), F.col("price"))).alias("ask"),
        F.sum(F.when(F.col("side") == "bids", F.col("n"))).alias("bids"), F.sum(F.when(F.col("side") == "asks", F.col("n"))).alias("asks"),
    )
    parts = parts.join(spans, lines, "left")
    fits = lambda side: F.coalesce(F.sum(side).over(upto), F.lit(0)) < F.col("retained")
    plain = F.coalesce(F.max("bid").over(upto) < F.min("ask").over(upto), F.lit(False)) & fits("bids") & fits("asks")
    parts = parts.withColumn("plain", plain).withColumn("fine", F.min(F.col("plain") & F.col("sound")).over(upto)).withColumn("new", F.coalesce(F.lag("fine").over(ahead), F.lit(True)))
    # the book waits in all parts after the one in which it was shut while all was fine; its sequence stays
    earlier = ahead.rowsBetween(Window.unboundedPreceding, -1)
    closes = F.col("new") & F.col("plain") & F.col("broke.kind").isin(*SHUT)
    never = F.when((F.col("end.exchange") == "OKX") & (F.col("segment") == 0) & F.lag("end").over(ahead).isNotNull(), 0)
    parts = parts.withColumn("waits", F.coalesce(F.max(F.when(closes, F.col("broke.last_id"))).over(earlier), never)).withColumn("shut", F.coalesce(F.last("shut", ignorenulls=True).over(earlier), F.lit(CONNECTING)))
    # a part begins anew if all before it are fine or the book waits; others go on with the last that does
    parts = parts.withColumn("new", F.col("new") | F.col("waits").isNotNull()).withColumn("of", F.max(F.when(F.col("new"), F.col("stretch"))).over(upto))
    parts = parts.select(*lines, "fine", "new", "of", "waits", "shut", F.lag("end").over(ahead).alias("was"), F.row_number().over(ahead).alias("i"), F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("int").alias("n"))

    # a price's last quantity is held in all parts until that in which it is set again
    begins = parts.where("new and was is not null")
    spread = last.join(parts.select(*lines, "fine", "i", "n"), lines).where("fine")
    spread = spread.withColumn("to", F.coalesce(F.lead("i").over(Window.partitionBy(*keys, "side", "price").orderBy("i")), "n")).where("qty > 0 and i < to")
    met = spread.select(*keys, "side", "price", "qty", F.explode(F.sequence(F.col("i") + 1, F.col("to"))).alias("i")).join(begins.where("waits is null").select(*lines, "i"), [*keys, "i"])
    level = F.struct("price", "qty")
    books = met.groupBy(*lines).agg(*(F.collect_list(F.when(F.col("side") == side, level)).alias(side) for side in ("bids", "asks")))
    types = {f.name: f.dataType for f in events.schema}
    made = {
        **{x: F.col(x) for x in keys}, **{x: F.col(f"was.{x}") for x in ("exchange", "market_type", "arrival_seq", "arrival_time", "source_time")},
        "kind": F.when(F.col("waits").isNull(), HELD).otherwise(F.col("shut")), "final_id": F.coalesce("waits", "was.final_id"), "first_id": (F.col("was.kind") == "update").cast("long"),
        **{x: F.coalesce(x, F.array()) for x in ("bids", "asks")},
    }
    held = begins.join(books, lines, "left").select(*(made.get(c, F.lit(None)).cast(types[c]).alias(c) for c in events.columns), "stretch")
    dealt = rows.join(parts.select(*lines, "of"), lines).select(*events.columns, F.col("of").alias("stretch"))
    return dealt.unionByName(held)


def replay_log(events: DataFrame, depth: int = DEPTH, by_second: bool = False) -> DataFrame:
    """The book after every event of a log (schemas.BOOK_EVENT), for each instrument in order of arrival.

    A batch twin of the stream.  What a book does is one sequence from one
    snapshot to the next, so the log is dealt by connection and segment and
    one instrument's log is the work of many tasks; a segment is fed through in
    batches, and its state is one book.  Long segments are dealt on by
    ``stretches``.  With ``by_second`` the log has ``next_time``, when an
    instrument's next row comes, and only views that still stand at a whole
    second come out, with it, which is all that sampling needs.  A log that has
    its segments already keeps them.
    """
    out = T.StructType([*VIEW, T.StructField("next_time", T.TimestampType())]) if by_second else VIEW
    keys = ["instrument_id", "conn_id", "segment", "stretch"]
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that few bytes of much work aren't put together
    ordered = stretches(events if "segment" in events.columns else segments(events)).repartition(tasks, *keys).sortWithinPartitions(*keys, "arrival_seq")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feed, at = None, None
        for frame in batches:
            rows = []
            for row in frame.to_dict("records"):
                here = (row["instrument_id"], row["conn_id"], row["segment"], row["stretch"])
                event = event_of(row)
                if here != at:
                    feed, at = Feed.of(row["exchange"], row["market_type"]), here
                if event["kind"] in (HELD, CONNECTING, *SHUT.values()):  # what was held when the stretch began, which is no event
                    feed.resume(event)
                    continue
                reason = feed.apply(event)
                if not by_second:
                    rows.append(view(feed, event, reason, depth))
                elif pd.isna(event["next_time"]) or _second(event["next_time"]) > _second(event["arrival_time"]):
                    rows.append(view(feed, event, reason, depth) | {"next_time": event["next_time"]})
            yield pd.DataFrame(rows, columns=out.names)

    return ordered.mapInPandas(parts, out)


def _second(time: Any) -> int:
    """The first whole second that isn't before a time."""
    return -(-pd.Timestamp(time).value // 1_000_000_000)


def chain_breaks(updates: DataFrame, keys: list[str], order: str = "arrival_seq") -> DataFrame:
    """Set-based continuity of feeds that name their predecessor: ``gap`` where prev_id isn't the last final_id.

    Updates that don't go beyond what was seen are no-ops and are left out
    first, as the feeds' rules have it; the first of each key has no gap.
    """
    seen = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fresh = updates.withColumn("_top", F.max("final_id").over(seen)).where(F.col("_top").isNull() | (F.col("final_id") > F.col("_top")))
    last = F.lag("final_id").over(Window.partitionBy(*keys).orderBy(order))
    return fresh.withColumn("gap", F.coalesce(F.col("prev_id") != last, F.lit(False))).drop("_top")


def range_breaks(updates: DataFrame, keys: list[str], order: str = "arrival_seq") -> DataFrame:
    """The same for feeds that give ranges: ``gap`` where first_id is beyond the last final_id by more than one."""
    seen = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fresh = updates.withColumn("_top", F.max("final_id").over(seen)).where(F.col("_top").isNull() | (F.col("final_id") > F.col("_top")))
    return fresh.withColumn("gap", F.coalesce(F.col("first_id") > F.col("_top") + 1, F.lit(False))).drop("_top")
