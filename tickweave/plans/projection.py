"""Test tables seen as market data: one hour of events is one second of a book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.operators.ordering import previous

#: Prices a side, more than the depth that is kept.
PRICES = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their instrument, 1 and up by name of the type; types are few, so they are numbered apart and broadcast."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    types = rows.select("event_type").distinct().withColumn("instrument_id", F.row_number().over(Window.orderBy("event_type")).cast("long"))
    return rows.join(F.broadcast(types), "event_type")


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (instrument_id, sec, minute, second, side, price, qty, event_id): bids at ticks 1 to 60, asks at 61 to 120, which never cross."""
    bid = F.col("event_id") % 2 == 0
    sec = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    return events(spark, sf_dir).select(
        "instrument_id", sec.alias("sec"), F.floor(sec / 60).cast("long").alias("minute"), (sec % 60).alias("second"),
        F.when(bid, "bid").otherwise("ask").alias("side"),
        F.when(bid, PRICES - F.col("user_id") % PRICES).otherwise(PRICES + 1 + F.col("user_id") % PRICES).cast("long").alias("price"),
        (F.col("event_id") % 4).alias("qty"), "event_id",
    )


def held_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid seconds of every instrument's book: all from 0 to the last, but for one in seven."""
    rows = writes(spark, sf_dir)
    span = rows.agg(F.max("sec").alias("top"))
    each = rows.select("instrument_id").distinct().join(F.broadcast(span)).withColumn("sec", F.explode(F.sequence(F.lit(0), "top")))
    valid = each.where((F.col("instrument_id") + F.col("sec")) % 7 != 3)
    return valid.select("instrument_id", "sec", F.floor(F.col("sec") / 60).cast("long").alias("minute"), (F.col("sec") % 60).alias("second"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels held at valid seconds: each price's last write, carried to the next."""
    rows = writes(spark, sf_dir)
    last = rows.groupBy("instrument_id", "side", "price", "sec").agg(F.max_by("qty", "event_id").alias("qty"))
    top = rows.agg(F.max("sec").alias("top"))
    order = Window.partitionBy("instrument_id", "side", "price").orderBy("sec")
    spans = last.withColumn("_to", F.lead("sec").over(order) - 1).join(F.broadcast(top)).where("qty > 0")
    held = spans.withColumn("sec", F.explode(F.sequence("sec", F.coalesce("_to", "top"))))
    held = held.where((F.col("instrument_id") + F.col("sec")) % 7 != 3)
    return held.select(
        "instrument_id", F.floor(F.col("sec") / 60).cast("long").alias("minute"), (F.col("sec") % 60).alias("second"), "side", "price", "qty"
    )


def settlement(ts: str = "ts") -> Column:
    """The next eight-hour boundary after a time, in seconds."""
    return F.floor(F.unix_seconds(ts) / 28800).cast("long") * 28800 + 28800


#: Seconds of events that follow each other, and of silence after them.
BLOCK, PAUSE = 150, 130


def book_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an update of its instrument's book (schemas.BOOK_EVENT), with silences and new snapshots.

    After each block of seconds the feeds pause.  Two of three blocks of an
    instrument begin with a snapshot of the worst prices; in the others its
    book stays invalid.  Quantities are 1 to 4, so no level goes.
    """
    sec = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    rows = events(spark, sf_dir).withColumn("block", F.floor(sec / BLOCK).cast("long"))
    at = (sec + PAUSE * F.col("block")) * 1_000_000 + (F.minute("ts") * 60 + F.second("ts")) * 277
    bid, price = F.col("event_id") % 2 == 0, F.col("user_id") % PRICES
    level = lambda price, qty: F.array(F.struct(price.cast("long").alias("price"), qty.cast("decimal(20,0)").alias("qty")))
    one = level(F.when(bid, PRICES - price).otherwise(PRICES + 1 + price), F.col("event_id") % 4 + 1)
    none = F.array().cast(one_type := "array<struct<price:bigint,qty:decimal(20,0)>>")
    updates = rows.select(
        "instrument_id", "block", (F.col("event_id") * 2 + 1).alias("arrival_seq"), at.alias("at"), F.lit("update").alias("kind"),
        F.when(bid, one).otherwise(none).cast(one_type).alias("bids"), F.when(~bid, one).otherwise(none).cast(one_type).alias("asks"),
    )
    starts = updates.groupBy("instrument_id", "block").agg(F.min("arrival_seq").alias("arrival_seq"), F.min("at").alias("at")).where((F.col("instrument_id") + F.col("block")) % 3 != 0)
    snapshots = starts.select(
        "instrument_id", "block", (F.col("arrival_seq") - 1).alias("arrival_seq"), "at", F.lit("snapshot").alias("kind"),
        level(F.lit(1), F.lit(1)).cast(one_type).alias("bids"), level(F.lit(2 * PRICES), F.lit(1)).cast(one_type).alias("asks"),
    )
    log = previous(updates.unionByName(snapshots), ["instrument_id"], "arrival_seq", "arrival_seq", "before")
    before, time = F.coalesce("before", F.lit(0)), F.timestamp_micros("at")
    return log.select(
        "instrument_id", F.lit("OKX").alias("exchange"), F.lit("perpetual").alias("market_type"), F.lit(1).cast("long").alias("conn_id"), "arrival_seq", time.alias("arrival_time"), "kind",
        F.lit(None).cast("long").alias("first_id"), F.col("arrival_seq").alias("final_id"), F.when(F.col("kind") == "update", before).otherwise(-1).cast("long").alias("prev_id"),
        time.alias("source_time"), "bids", "asks",
    )


#: Rows of a log from one snapshot to the next, and the prices between which its books are.
STRETCH, MIDDLE = 97, 2000


def faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a row of its instrument's log (schemas.BOOK_EVENT), with a fault in most stretches.

    Instruments of even number are an exchange's that chains its updates,
    others one's that gives ranges.  A stretch starts with a snapshot, deep in
    the fifth and sixth of eight; then come, in the second to the eighth: a
    gap, a sequence that falls back, a crossing, levels beyond the retained
    depth, too many levels lost, a first update that doesn't follow the
    snapshot, and a crossed snapshot.
    """
    order = Window.partitionBy("instrument_id").orderBy("event_id")
    rows = events(spark, sf_dir).withColumn("n", F.row_number().over(order) - 1)
    chained = F.col("instrument_id") % 2 == 0
    at, kind = F.col("n") % STRETCH, F.floor(F.col("n") / STRETCH) % 8
    retained = F.when(chained, 400).otherwise(1000)
    typed = "array<struct<price:bigint,qty:decimal(20,0)>>"
    ladder = lambda count, price, qty: F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(price(i).alias("price"), qty.alias("qty"))).cast(typed)
    one = lambda price, qty: F.array(F.struct(price.alias("price"), qty.alias("qty"))).cast(typed)
    none, lot = F.array().cast(typed), F.col("event_id") % 4
    deep, crossed = kind.isin(4, 5), (kind == 7) & (at == 40)
    snapshot = (at == 0) | crossed
    bid = F.col("event_id") % 2 == 0
    bids = (
        F.when(crossed, one(F.lit(MIDDLE + 5), F.lit(1)))
        .when(snapshot & deep, ladder(retained, lambda i: MIDDLE - 2 * i, F.lit(2)))
        .when(snapshot, ladder(F.lit(10), lambda i: MIDDLE - i, F.lit(2)))
        .when((kind == 3) & (at == 60), one(F.lit(MIDDLE + 500), F.lit(1)))
        .when((kind == 5) & (at == 50), ladder(retained - 20, lambda i: MIDDLE - 2 * i, F.lit(0)))
        .when(bid, one(MIDDLE - F.col("user_id") % 60, lot))
        .otherwise(none)
    )
    asks = F.when(snapshot, ladder(F.lit(10), lambda i: MIDDLE + 1 + i, F.lit(3))).when(~bid & ~((kind == 3) & (at == 60)) & ~((kind == 5) & (at == 50)), one(MIDDLE + 1 + F.col("user_id") % 60, lot)).otherwise(none)
    skip = F.when((kind == 1) & (at == 50) | (kind == 6) & (at == 1), 3).otherwise(0)
    before = F.col("n") * 10 - 5
    final = F.when((kind == 2) & (at == 50), before - 1).otherwise(before + 10)
    long = lambda c: c.cast("long")
    return rows.select(
        "instrument_id", F.when(chained, "OKX").otherwise("Binance").alias("exchange"), F.when(chained, "perpetual").otherwise("spot").alias("market_type"), F.lit(1).cast("long").alias("conn_id"),
        F.col("event_id").alias("arrival_seq"), F.col("ts").alias("arrival_time"), F.when(snapshot, "snapshot").otherwise("update").alias("kind"), long(F.when(~snapshot, before + 1 + skip)).alias("first_id"),
        long(final).alias("final_id"), long(F.when(snapshot, -1).otherwise(before + skip)).alias("prev_id"), F.col("ts").alias("source_time"), bids.alias("bids"), asks.alias("asks"),
    )
