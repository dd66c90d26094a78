"""Actual rates asked for after each settlement: attempts by the clock, one exchange one request at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickweave.operators.funding import DELAYS, SPACING
from tickweave.schemas import database_name
from tickweave.sources import binance, okx, rest, store

_f = T.StructField
#: What the worker is told: a settlement to confirm (kind ``task``), or one that the store has an actual rate of (``confirmed``).
NEWS = T.StructType([_f("exchange", T.StringType()), _f("kind", T.StringType()), _f("instrument_id", T.LongType()), _f("exchange_symbol", T.StringType()), _f("funding_time", T.TimestampType())])
REQUEST = T.StructType([_f("exchange", T.StringType()), _f("instrument_id", T.LongType()), _f("exchange_symbol", T.StringType()), _f("funding_time", T.TimestampType()), _f("attempt", T.IntegerType())])
KEY = T.StructType([_f("instrument_id", T.LongType()), _f("funding_ms", T.LongType())])
OPEN = T.StructType([_f("symbol", T.StringType()), _f("attempt", T.IntegerType()), _f("due_ms", T.LongType())])
AT = T.StructType([_f("at_ms", T.LongType())])
#: How long a settlement that is done with isn't taken again.
REMEMBERED_MS = 48 * 3_600_000

Key = tuple[int, int]


class Confirmations:
    """One exchange's open settlements, each with its next attempt, and those that are done with."""

    def __init__(self, delays: tuple[int, ...] = DELAYS, spacing: int = SPACING) -> None:
        self.delays, self.spacing = [60_000 * m for m in delays], 1000 * spacing
        self.open: dict[Key, tuple[str, int, int]] = {}
        self.done: dict[Key, int] = {}
        self.last: int | None = None

    def schedule(self, key: Key, symbol: str, now: int) -> None:
        """Takes a settlement that isn't known: the last attempt whose time has passed is due at once, else the first in its time."""
        if key in self.open or key in self.done:
            return
        passed = [k for k, d in enumerate(self.delays) if key[1] + d <= now]
        self.open[key] = (symbol, passed[-1], now) if passed else (symbol, 0, key[1] + self.delays[0])
        self.done = {k: at for k, at in self.done.items() if at >= now - REMEMBERED_MS}

    def confirmed(self, key: Key, now: int) -> None:
        """The store has the rate, whoever asked for it."""
        self.open.pop(key, None)
        self.done[key] = now

    def next_at(self) -> int | None:
        """When the next request may go out."""
        if not self.open:
            return None
        due = min(due for _, _, due in self.open.values())
        return due if self.last is None else max(due, self.last + self.spacing)

    def ask(self, now: int) -> tuple[Key, str, int] | None:
        """The request that goes out now, if one is due and the exchange may be asked; its settlement waits for the next delay, or is given up after the last."""
        at = self.next_at()
        if at is None or at > now:
            return None
        key = min(self.open, key=lambda k: (self.open[k][2], k))
        symbol, attempt, _ = self.open[key]
        self.last = now
        if attempt + 1 < len(self.delays):
            self.open[key] = (symbol, attempt + 1, key[1] + self.delays[attempt + 1])
        else:
            del self.open[key]
            self.done[key] = now
        return key, symbol, attempt


class ConfirmationProcessor(StatefulProcessor):
    """An exchange's ``Confirmations`` in the state store; a timer of the clock for the next request."""

    def __init__(self, delays: tuple[int, ...] = DELAYS, spacing: int = SPACING) -> None:
        self.delays, self.spacing = delays, spacing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open, self.done = handle.getMapState("open", KEY, OPEN), handle.getMapState("done", KEY, AT)
        self.last = handle.getValueState("last", AT)

    def _load(self) -> Confirmations:
        own = Confirmations(self.delays, self.spacing)
        own.open = {tuple(k): tuple(v) for k, v in self.open.iterator()}
        own.done = {tuple(k): v[0] for k, v in self.done.iterator()}
        own.last = self.last.get()[0] if self.last.exists() else None
        self.was = dict(own.open), dict(own.done)
        return own

    def _save(self, own: Confirmations) -> None:
        for state, was, now in ((self.open, self.was[0], own.open), (self.done, self.was[1], {k: (v,) for k, v in own.done.items()})):
            for key in was.keys() - now.keys():
                state.removeKey(key)
            for key, value in now.items():
                if was.get(key) not in (value, value[0]):
                    state.updateValue(key, value)
        if own.last is not None:
            self.last.update((own.last,))
        at = own.next_at()
        if at is not None:
            self.handle.registerTimer(at)

    def _asked(self, exchange: str, own: Confirmations, now: int) -> pd.DataFrame:
        found = own.ask(now)
        self._save(own)
        rows = [] if found is None else [(exchange, found[0][0], found[1], pd.Timestamp(found[0][1], unit="ms"), found[2])]
        return pd.DataFrame(rows, columns=REQUEST.names)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now, own = timerValues.getCurrentProcessingTimeInMs(), self._load()
        for frame in rows:
            for row in frame.to_dict("records"):
                settlement = int(row["instrument_id"]), pd.Timestamp(row["funding_time"]).value // 1_000_000
                if row["kind"] == "confirmed":
                    own.confirmed(settlement, now)
                else:
                    own.schedule(settlement, row["exchange_symbol"], now)
        yield self._asked(key[0], own, now)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield self._asked(key[0], self._load(), timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def confirmed(spark: SparkSession, database: str, instruments: DataFrame) -> DataFrame:
    """The store's actual rates as a stream of NEWS: what has been written, by this worker or by a backfill."""
    rows = spark.readStream.table(f"{database_name(database)}.funding_rate_hourly").where("is_actual").select("instrument_id", "funding_time")
    known = rows.join(instruments.select("instrument_id", "exchange", "exchange_symbol"), "instrument_id")
    return known.withColumn("kind", F.lit("confirmed")).select(*NEWS.names)


def requests(news: DataFrame, delays: tuple[int, ...] = DELAYS, spacing: int = SPACING) -> DataFrame:
    """The requests (REQUEST) that a stream of NEWS leads to, each when it is due; needs the RocksDB state store.

    A batch sends an exchange one request at most, ``spacing`` seconds after
    the one before.  What is confirmed meanwhile is not asked for again; after
    the last delay a settlement is given up.
    """
    return news.groupBy("exchange").transformWithStateInPandas(ConfirmationProcessor(delays, spacing), outputStructType=REQUEST, outputMode="append", timeMode="processingTime")


def answers(asked: DataFrame, get_: Callable[[str, int], str] = rest.get) -> DataFrame:
    """Rows (instrument_id, funding_time, rate) of what exchanges answer to requests; one attempt each, and a failed one has no rate."""
    millis = F.unix_millis("funding_time").cast("string")
    urls = [(e, rest.funding_history_url(e, "{symbol}", 0)) for e in ("Binance", "OKX")]
    url = F.lit(None).cast("string")
    for exchange, form in urls:
        form = form.replace("startTime=0&endTime=1", "startTime={a}&endTime={b}")
        text = F.lit(form)
        for name, value in (("{symbol}", F.col("exchange_symbol")), ("{a}", millis), ("{b}", (F.unix_millis("funding_time") + 1).cast("string"))):
            text = F.replace(text, F.lit(name), value)
        url = F.when(F.col("exchange") == exchange, text).otherwise(url)

    def one(address: str, attempts: int) -> str:
        try:
            return get_(address, attempts)
        except Exception:  # noqa: BLE001  whatever it is, the settlement stays open and is asked for again
            return ""

    got = rest.fetch(asked.withColumn("url", url), 1, one).drop("url")
    parsed = [parse(got.where(F.col("exchange") == e)).select("instrument_id", "funding_time", "rate") for e, parse in (("Binance", binance.funding_history), ("OKX", okx.funding_history))]
    return parsed[0].unionByName(parsed[1])


def confirm(news: DataFrame, database: str, checkpoint: str, get_: Callable[[str, int], str] = rest.get, trigger: str | None = "1 second", **options) -> StreamingQuery:
    """Asks for actual rates as they are due and writes them to the store, whose actual rows come back as NEWS of kind ``confirmed``.

    Without a ``trigger`` what is there is worked off once.
    """

    def write(batch: DataFrame, number: int) -> None:
        asked = batch.persist()
        try:
            if not asked.isEmpty():
                store.confirm(asked.select("instrument_id", "funding_time"), answers(asked, get_), database, F.lit(number))
        finally:
            asked.unpersist()

    out = requests(news, **options).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=trigger) if trigger else out.trigger(availableNow=True)).start()
