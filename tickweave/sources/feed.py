"""Recorded feed messages as a stream: JSON lines in files, in order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.operators.ordering import following

#: A connection that is silent for longer is broken; funding of OKX may be silent for two minutes.
SILENCE, SILENCE_OKX_FUNDING = 45, 120
#: Seconds before a feed is asked again: doubled from the first to the longest.
RECONNECT, LONGEST = 1, 30

MESSAGE = "instrument_id long, conn_id long, arrival_seq long, arrival_time timestamp, payload string"


def messages(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(MESSAGE).json(path)


def with_faults(events: DataFrame, silence: int = SILENCE, until: Column | None = None, next_time: str | None = None) -> DataFrame:
    """A log with an ``invalidate`` row where a connection was silent too long: sockets' faults become rows of the log.

    The row comes when the silence has lasted ``silence`` seconds, after the
    connection's last event; sequence numbers are doubled to make room for it.
    With ``until``, up to which nothing more has arrived, the end of the log
    counts too.  A column named by ``next_time`` tells when an instrument's
    next row comes, null for its last.
    """
    seen = following(events, ["instrument_id"], "arrival_seq", "arrival_time", "_next")
    gap = F.unix_micros("_next") - F.unix_micros("arrival_time")
    limit = silence * 1_000_000
    late = F.coalesce(gap > limit, F.unix_micros(until) - F.unix_micros("arrival_time") >= limit if until is not None else F.lit(False), F.lit(False))
    spread = seen.withColumn("_late", late).withColumn("_fault", F.explode(F.when(F.col("_late"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    fault = F.col("_fault") == 1
    blank = {c: F.when(~fault, F.col(c)) for c in ("first_id", "final_id", "prev_id", "source_time", "bids", "asks")}
    silent = F.timestamp_micros(F.unix_micros("arrival_time") + limit)
    rows = spread.withColumns(
        blank
        | ({next_time: F.when(F.col("_late") & ~fault, silent).otherwise(F.col("_next"))} if next_time else {})
        | {
            "kind": F.when(fault, "invalidate").otherwise(F.col("kind")), "arrival_seq": F.col("arrival_seq") * 2 + F.col("_fault"),
            "arrival_time": F.when(fault, silent).otherwise(F.col("arrival_time")),
        }
    )
    return rows.drop("_late", "_fault", "_next")


def reconnect_delay(failures: int) -> int:
    """Seconds before attempt number ``failures`` + 1; never set back, however long the connection held."""
    return min(RECONNECT * 2**failures, LONGEST)
