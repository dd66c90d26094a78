"""Books at a second from stored minutes: not found, invalid, or a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions import ids
from tickweave.schemas import DEPTH, SIDES


def levels(prices: str, qtys: str, of: Column | None = None) -> Column:
    """Both sides' levels, given the names of their arrays behind ``bid`` and ``ask`` (columns, or fields of a struct), as one array of (side, price, qty)."""

    def one(side: str) -> Column:
        p, q = (F.col(f"{side}_{n}") if of is None else of[f"{side}_{n}"] for n in (prices, qtys))
        pairs = F.arrays_zip(p.alias("price"), q.alias("qty"))
        return F.transform(pairs, lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["qty"].alias("qty")))

    return F.concat(*map(one, SIDES))


def writes(minutes: DataFrame, deltas: DataFrame | None = None) -> DataFrame:
    """Rows (minute_id, valid_bitmap, second, side, price, qty): the anchor's levels at second 0, then every change.

    Deltas count only with their minute, as the minute is what makes them
    visible, and only at seconds that it has as valid.  Without ``deltas``
    each minute has its own in a column of that name, and nothing is joined.
    """
    if deltas is None:
        first = F.struct(F.lit(0).alias("second_offset"), *[F.col(f"{s}_{n}").alias(f"{s}_change_{n}") for s in SIDES for n in ("prices", "qtys")])
        each = minutes.select(F.col("id").alias("minute_id"), "valid_bitmap", F.inline(F.concat(F.array(first), F.col("deltas"))))
        held = each.where(ids.is_set(F.col("valid_bitmap"), F.col("second_offset")))
        return held.select("minute_id", "valid_bitmap", F.col("second_offset").alias("second"), F.inline(levels("change_prices", "change_qtys")))
    first = minutes.select(F.col("id").alias("minute_id"), "valid_bitmap", F.lit(0).alias("second"), F.inline(levels("prices", "qtys")))
    held = deltas.join(minutes.select(F.col("id").alias("minute_id"), "valid_bitmap"), "minute_id")
    held = held.where(ids.is_set(F.col("valid_bitmap"), F.col("second_offset")))
    return first.unionByName(held.select("minute_id", "valid_bitmap", F.col("second_offset").alias("second"), F.inline(levels("change_prices", "change_qtys"))))


def last_writes(rows: DataFrame, keys: list[str], order: str = "second", depth: int = DEPTH) -> DataFrame:
    """The book that rows of writes leave: the last quantity of each price, without zeros, the best ``depth`` of a side.

    Quantities are absolute and a price is written once a second, so the last
    write stands for the whole fold and one aggregate does it.
    """
    last = rows.groupBy(*keys, "side", "price").agg(F.max_by("qty", order).alias("qty")).where("qty > 0")
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    ranked = last.withColumn("level", F.row_number().over(Window.partitionBy(*keys, "side").orderBy(best)))
    return ranked.where(F.col("level") <= depth)


def at_second(minutes: DataFrame, deltas: DataFrame | None, second: int, depth: int = DEPTH) -> DataFrame:
    """Levels of every minute at one second of it; minutes where that second is invalid have none."""
    if not 0 <= second <= 59:
        raise ValueError(f"second {second} is not from 0 to 59")
    valid = minutes.where(ids.is_set(F.col("valid_bitmap"), F.lit(second)))
    if deltas is None:
        valid = valid.withColumn("deltas", F.filter("deltas", lambda d: d["second_offset"] <= second))
    else:
        deltas = deltas.where(F.col("second_offset") <= second)
    return last_writes(writes(valid, deltas), ["minute_id"], depth=depth)


def _held(rows: DataFrame, seconds: Column) -> DataFrame:
    """Levels that rows of writes leave at the seconds of a bitmap: a write holds until the next of its price, and is repeated for the seconds it spans."""
    order = Window.partitionBy("minute_id", "side", "price").orderBy("second")
    spans = rows.withColumn("_to", F.coalesce(F.lead("second").over(order), F.lit(60)) - 1).where("qty > 0")
    return spans.withColumn("second", F.explode(F.sequence("second", "_to"))).drop("_to").where(ids.is_set(seconds, F.col("second")))


def _ranked(held: DataFrame, depth: int) -> DataFrame:
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    ranked = held.withColumn("level", F.row_number().over(Window.partitionBy("minute_id", "second", "side").orderBy(best)))
    return ranked.where(F.col("level") <= depth)


def every_second(minutes: DataFrame, deltas: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """Levels of every minute at every valid second: rows (minute_id, second, side, price, qty, level).

    The cost is that of the levels returned.  Rows are dealt by minute once; a
    minute's levels are at most those of its 60 seconds.
    """
    rows = writes(minutes, deltas).repartition("minute_id")
    return _ranked(_held(rows, F.col("valid_bitmap")), depth).drop("valid_bitmap")


def books(requests: DataFrame, minutes: DataFrame, deltas: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The answer to each request (instrument_id, time): status not_found, invalid or valid, with the arrays of a valid book that holds levels.

    Many requests are one job: they meet their minute by id, the bit is tested
    before any delta is read, and only deltas up to the second are joined.  For
    many requests of each minute see ``books_of_whole``.
    """
    second = (F.unix_seconds("time") % 60).cast("int")
    asked = requests.select("instrument_id", "time").distinct().withColumn("minute_id", ids.minute_id(F.col("instrument_id"), F.col("time"))).withColumn("second", second)
    found = asked.join(minutes.withColumnRenamed("id", "minute_id").drop("instrument_id", "minute_time"), "minute_id", "left")
    status = F.when(F.col("valid_bitmap").isNull(), "not_found").when(ids.is_set(F.col("valid_bitmap"), F.col("second")), "valid").otherwise("invalid")
    found = found.withColumn("status", status)
    keys = ["instrument_id", "time", "status"]
    none = F.lit(None).cast("array<struct<side:string,price:bigint,qty:decimal(20,0)>>")
    book = F.when(F.col("status") == "valid", levels("prices", "qtys"))
    first = found.select(*keys, F.lit(0).alias("at"), F.inline_outer(F.coalesce(book, none)))
    near = found.where("status = 'valid'").select(*keys, "minute_id", "second", "valid_bitmap").join(deltas, "minute_id")
    near = near.where("second_offset <= second").where(ids.is_set(F.col("valid_bitmap"), F.col("second_offset")))
    rows = first.unionByName(near.select(*keys, F.col("second_offset").alias("at"), F.inline(levels("change_prices", "change_qtys"))))
    # one shuffle, by request, serves the last write of each price, the ranks and the arrays
    last = rows.repartition(*keys).groupBy(*keys, "side", "price").agg(F.max_by("qty", "at").alias("qty")).withColumn("_held", F.coalesce(F.col("qty") > 0, F.lit(False)))
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    ranked = last.withColumn("level", F.row_number().over(Window.partitionBy(*keys, "side", "_held").orderBy(best)))
    sides = []
    for side in SIDES:
        held = F.col("_held") & (F.col("side") == side) & (F.col("level") <= depth)
        pairs = F.sort_array(F.collect_list(F.when(held, F.struct("level", "price", "qty"))))
        for name, part in (("prices", "price"), ("qtys", "qty")):
            sides.append(F.when((F.col("status") == "valid") & F.bool_or("_held"), _part(pairs, part)).alias(f"{side}_{name}"))
    return ranked.groupBy(*keys).agg(*sides)


def books_of_whole(requests: DataFrame, whole: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``books`` from minutes that have their deltas in one row each, made for many requests of a minute.

    The seconds that are asked of a minute are one bitmap; its writes are
    unfolded once, whatever is asked of it, and repeated for the seconds they
    span.  A row of its own keeps a second that has no level.
    """
    asked = requests.select("instrument_id", "time").distinct().withColumn("minute_id", ids.minute_id(F.col("instrument_id"), F.col("time"))).withColumn("second", (F.unix_seconds("time") % 60).cast("int"))
    wanted = asked.groupBy(F.col("minute_id").alias("id")).agg(ids.bitmap(F.col("second")).alias("_asked"))
    found = wanted.join(whole, "id")
    mark = F.struct(F.lit("").alias("side"), F.lit(0).cast("long").alias("price"), F.lit(1).cast("decimal(20,0)").alias("qty"))
    first = F.struct(F.lit(0).alias("second"), F.concat(F.array(mark), levels("prices", "qtys")).alias("levels"))
    rest = F.transform("deltas", lambda d: F.struct(d["second_offset"].alias("second"), levels("change_prices", "change_qtys", d).alias("levels")))
    each = found.select(F.col("id").alias("minute_id"), "valid_bitmap", "_asked", F.inline(F.concat(F.array(first), rest)))
    # a mark stands at every second that is asked for, a write counts only if its second is valid
    rows = each.select("minute_id", "valid_bitmap", "_asked", "second", F.inline("levels")).where((F.col("side") == "") | ids.is_set(F.col("valid_bitmap"), F.col("second")))
    seconds = F.when(F.col("side") == "", F.col("_asked")).otherwise(F.col("_asked").bitwiseAND(F.col("valid_bitmap")))
    held = _ranked(_held(rows.repartition("minute_id"), seconds), depth)
    sides = []
    for side in SIDES:
        pairs = F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("level", "price", "qty"))))
        sides += [F.when(F.bool_or(F.col("side") != ""), _part(pairs, part)).alias(f"{side}_{name}") for name, part in (("prices", "price"), ("qtys", "qty"))]
    answers = held.groupBy("minute_id", "second").agg(F.first("valid_bitmap").alias("_bits"), *sides)
    status = F.when(F.col("_bits").isNull(), "not_found").when(ids.is_set(F.col("_bits"), F.col("second")), "valid").otherwise("invalid")
    return asked.join(answers, ["minute_id", "second"], "left").select("instrument_id", "time", status.alias("status"), *[f"{s}_{n}" for s in SIDES for n in ("prices", "qtys")])


def _part(pairs: Column, name: str) -> Column:
    return F.transform(pairs, lambda x: x[name])


def json_of() -> Column:
    """An answer as a JSON object: valid, and the snapshot only if it is."""
    book = F.struct(*[f"{s}_{k}" for s in SIDES for k in ("prices", "qtys")], F.col("time").alias("source_time"))
    valid = F.col("status") == "valid"
    return F.to_json(F.struct(valid.alias("valid"), F.when(valid, book).alias("snapshot")))


def as_json(answers: DataFrame) -> DataFrame:
    return answers.select(json_of().alias("value"))
