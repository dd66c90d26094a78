"""Command line: print the DDL, collect a log of book events into the stored tables, or replay a book at a second."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tickweave import schemas
from tickweave.functions.ids import MAX_INSTRUMENT
from tickweave.operators import replay
from tickweave.sources import store
from tickweave.sources.config import Config
from tickweave.streaming import books

#: Files of a log that one batch takes, which bounds what a task holds of one instrument.
FILES = 64


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tickweave")
    parser.add_argument("--print-ddl", action="store_true")
    parser.add_argument("--collect", metavar="LOG", help="Parquet folder of book events (schemas.BOOK_EVENT); what is new in it is sampled and stored")
    parser.add_argument("--checkpoint", help="folder in which the state of the books is kept from one run to the next")
    parser.add_argument("--replay-instrument", type=int)
    parser.add_argument("--replay-time", help="RFC 3339, as 2026-01-02T03:04:05Z")
    got = parser.parse_args(argv)
    if (got.replay_instrument is None) != (got.replay_time is None):
        parser.error("--replay-instrument and --replay-time go together")
    if (got.collect is None) != (got.checkpoint is None):
        parser.error("--collect and --checkpoint go together")
    if got.replay_instrument is not None:
        if not 1 <= got.replay_instrument <= MAX_INSTRUMENT:
            parser.error("--replay-instrument is out of range")
        try:
            time = datetime.fromisoformat(got.replay_time.replace("Z", "+00:00"))
        except ValueError:
            parser.error("--replay-time is not RFC 3339")
        if time.tzinfo is None:
            parser.error("--replay-time has no offset")
        got.replay_time = time.astimezone(timezone.utc).replace(microsecond=0)
    return got


def session() -> SparkSession:
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.streaming.stateStore.providerClass": books.STATE_STORE}
    return SparkSession.builder.config(map=settings).getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    got, config = arguments(argv), Config.load()
    if got.print_ddl:
        out = [f"{x};" for x in schemas.ddl(config.database)]
    elif got.collect is not None:
        spark = spark or session()
        store.init(spark, config.database)
        events = spark.readStream.schema(schemas.BOOK_EVENT).option("maxFilesPerTrigger", FILES).parquet(got.collect)
        query = books.store_minutes(events, config.database, got.checkpoint)
        query.awaitTermination()
        late = books.dropped(query)
        if late:
            raise SystemExit(f"{late} events lie further back than {books.DELAY} and are not in the stored minutes")
        out = []
    elif got.replay_instrument is not None:
        spark = spark or session()
        asked = spark.createDataFrame([(got.replay_instrument, got.replay_time)], "instrument_id long, time timestamp")
        month = [got.replay_time.strftime("%Y%m")]
        minute, second = divmod(int(got.replay_time.timestamp()), 60)
        key = minute << 32 | got.replay_instrument
        minutes = store.read(spark, config.database, "order_book_minute", f"instrument_id = {got.replay_instrument} and minute_time = timestamp_seconds({minute * 60})", month)
        deltas = store.read(spark, config.database, "order_book_second_delta", f"minute_id = {key} and second_offset <= {second}", month)
        answers = replay.books(asked, minutes, deltas)
        (answer,) = answers.select("status", replay.json_of().alias("value")).collect()
        if answer.status == "not_found":
            raise SystemExit("not found")
        out = [answer.value]
    else:
        out = []
    print(*out, sep="\n")
    return out


if __name__ == "__main__":
    main()
