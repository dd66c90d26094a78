"""Books, samples and estimates as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickweave.operators.book import VIEW, Feed, event_of, view
from tickweave.operators.versions import SEQ
from tickweave.schemas import DELTA, ESTIMATE, MINUTE
from tickweave.sources import store
from tickweave.sources.feed import SILENCE
from tickweave.streaming.state import BookState, Sampler, SamplerState, waits

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How far the events of a log may be out of the order of their arrival.
DELAY = "10 seconds"


class BookProcessor(StatefulProcessor):
    """One instrument's book as state; a new connection starts another."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BookState(handle)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        feed, conn = self.state.load()
        out = []
        for row in _in_order(rows):
            if feed is None or row["conn_id"] != conn:
                feed, conn = Feed.of(row["exchange"], row["market_type"]), int(row["conn_id"])
            event = event_of(row)
            out.append(view(feed, event, feed.apply(event)))
            if feed.held and feed.held[-1] is event:
                feed.held[-1] = waits(event)
        self.state.save(feed, conn)
        yield pd.DataFrame(out, columns=VIEW.names)

    def close(self) -> None:
        pass


def _in_order(rows: Iterator[pd.DataFrame]) -> list[dict]:
    """A key's rows of one micro-batch, which the source bounds, in order of arrival."""
    return pd.concat(list(rows)).sort_values("arrival_seq").to_dict("records")


def books(events: DataFrame) -> DataFrame:
    """The book after every event of a stream of schemas.BOOK_EVENT; needs the RocksDB state store."""
    return events.groupBy("instrument_id").transformWithStateInPandas(BookProcessor(), outputStructType=VIEW, outputMode="append", timeMode="none")


#: A whole minute: the stored row and its deltas.
WHOLE_MINUTE = T.StructType([*MINUTE.fields, T.StructField("deltas", T.ArrayType(T.StructType([x for x in DELTA if x.name != "minute_id"])))])


class MinuteProcessor(StatefulProcessor):
    """One instrument's book sampled at whole seconds of arrival time; a minute comes out as soon as the watermark has passed it.

    What the instrument's own events don't tell, the watermark does: a timer at
    the end of each minute ends it without a later event, and seconds from the
    end of a silence on are not valid.  The minute that is under way waits in
    the state, also over a restart.
    """

    def __init__(self, silence: int = SILENCE) -> None:
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, SamplerState(handle, self.silence)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        sampler = self.state.load(int(key[0]))
        yield self._done(sampler, [minute for row in _in_order(rows) for minute in sampler.event(row)])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        seen = timerValues.getCurrentWatermarkInMs() * 1000
        if self.state.is_due(seen):  # else events have come further than the timer
            sampler = self.state.load(int(key[0]))
            yield self._done(sampler, sampler.until(seen))

    def _done(self, sampler: Sampler, out: list[dict]) -> pd.DataFrame:
        self.state.save(sampler)
        end = sampler.next_minute()
        if end is not None:
            self.handle.registerTimer(end * 1000)
        return pd.DataFrame(out, columns=WHOLE_MINUTE.names)

    def close(self) -> None:
        pass


def minutes(events: DataFrame, silence: int = SILENCE, delay: str = DELAY) -> DataFrame:
    """Whole minutes (WHOLE_MINUTE) of a stream of schemas.BOOK_EVENT; needs the RocksDB state store.

    ``delay`` is how far events of different instruments may be behind each
    other in the stream; what is further behind is dropped (see ``dropped``).
    """
    keyed = events.withWatermark("arrival_time", delay).groupBy("instrument_id")
    return keyed.transformWithStateInPandas(MinuteProcessor(silence), outputStructType=WHOLE_MINUTE, outputMode="append", timeMode="eventTime")


def dropped(query: StreamingQuery) -> int:
    """Events that came too late for the watermark in the batches that a query still knows."""
    return sum(op.numRowsDroppedByWatermark for batch in query.recentProgress for op in batch.stateOperators)


def split_minutes(whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(minutes, deltas) as they are stored, for a batch of whole minutes."""
    return whole.drop("deltas"), whole.select(F.col("id").alias("minute_id"), F.inline("deltas"))


def store_minutes(events: DataFrame, database: str, checkpoint: str, silence: int = SILENCE, delay: str = DELAY) -> StreamingQuery:
    """Writes the whole minutes of a stream of book events to the stored tables, each batch under its own number; one that is run again changes nothing.

    A minute that breaks a rule is set aside with its deltas and stops no other.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            store.write_sound_minutes(*split_minutes(batch), database, F.lit(number))
        finally:
            batch.unpersist()

    return minutes(events, silence, delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ESTIMATE_STATE = T.StructType([*ESTIMATE.fields, T.StructField("available", T.BooleanType())])
RETENTION_US = 48 * 3_600_000_000


class EstimateProcessor(StatefulProcessor):
    """One instrument's estimates: of each settlement the latest by source time, and whether its feed is up.

    An older estimate is passed over; an equal source time replaces.  A row of
    kind ``unavailable`` says that the feed is down; only an estimate that is
    taken says that it is up again.  Settlements whose source time is 48 hours
    behind the newest are forgotten.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", T.StructType([T.StructField("funding", T.LongType())]), T.StructType([T.StructField("source", T.LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        out, newest = [], None
        for row in pd.concat(list(rows)).sort_values("arrival_seq").to_dict("records"):
            base = {"instrument_id": row["instrument_id"], "funding_time": None, "rate": None, "source_time": None, "available": False}
            if row["kind"] == "unavailable":
                out.append(base)
                continue
            target, source = (pd.Timestamp(row[c]).value // 1000 for c in ("funding_time", "source_time"))
            if self.held.containsKey((target,)) and self.held.getValue((target,))[0] > source:
                continue
            self.held.updateValue((target,), (source,))
            newest = source if newest is None else max(newest, source)
            out.append(base | {c: row[c] for c in ("funding_time", "rate", "source_time")} | {"available": True})
        if newest is not None:
            for target in [k for k, v in self.held.iterator() if v[0] < newest - RETENTION_US]:
                self.held.removeKey(target)
        yield pd.DataFrame(out, columns=ESTIMATE_STATE.names)

    def close(self) -> None:
        pass


def latest_estimates(estimates: DataFrame) -> DataFrame:
    """What a stream of estimates (with ``kind`` and ``arrival_seq``) leaves to be known: rows that are taken, and when a feed goes down.

    The last row of an instrument and settlement is what the store holds.
    """
    return estimates.groupBy("instrument_id").transformWithStateInPandas(EstimateProcessor(), outputStructType=ESTIMATE_STATE, outputMode="append", timeMode="none")


def confirmation_tasks(estimates: DataFrame, delay: str = "48 hours") -> DataFrame:
    """Each settlement of a stream of estimates once within 48 hours."""
    rows = estimates.select("instrument_id", F.timestamp_millis(F.unix_millis("funding_time")).alias("funding_time"), "source_time")
    return rows.withWatermark("source_time", delay).dropDuplicatesWithinWatermark(["instrument_id", "funding_time"])


def append_each_batch(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Appends a stream to a Parquet table, each batch under its own number, so that one that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(SEQ, F.lit(number).cast("long") * 2**32 + F.monotonically_increasing_id() % 2**32)
        out = rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("batch", *(partition_by or [])).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)
