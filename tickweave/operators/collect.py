"""The collector over a whole log at once: books, silences, samples and stored minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.operators import book, lineage, sampler
from tickweave.sources.feed import SILENCE, with_faults


def samples(events: DataFrame, until: Column, silence: int = SILENCE) -> DataFrame:
    """Rows (instrument_id, minute, second, bid_prices, bid_qtys, ask_prices, ask_qtys) of every second with a valid book.

    A second has the state after the last event at or before it; a feed that
    is silent for longer than ``silence`` seconds has none until its next
    snapshot.  ``until`` is when the log ends, itself included.  The log with
    its faults and segments, which replay reads many times, is kept.
    """
    log = lineage.kept(book.segments(with_faults(events, silence, until, "next_time")), "log")
    views = book.replay_log(log, by_second=True)
    end = F.timestamp_micros(F.unix_micros(until) + 1)
    spans = views.withColumn("to_time", F.coalesce("next_time", end)).withColumnRenamed("arrival_time", "from_time").where("state = 'valid' and size(bid_prices) > 0")
    at = F.unix_seconds("second_time")
    return sampler.sample_grid(spans).select(
        "instrument_id", F.floor(at / 60).cast("long").alias("minute"), (at % 60).cast("int").alias("second"), "bid_prices", "bid_qtys", "ask_prices", "ask_qtys"
    )


def minutes(events: DataFrame, until: Column, silence: int = SILENCE) -> tuple[DataFrame, DataFrame]:
    """(minutes, deltas) as they are stored, of the minutes that are over by ``until``: the batch twin of the stream."""
    seconds = samples(events, until, silence).where((F.col("minute") + 1) * 60 <= F.unix_seconds(until))
    return sampler.split(sampler.minutes_of_books(seconds, "decimal(20,0)"))
