"""Minutes from samples: one anchor book, absolute deltas, and a bitmap of valid seconds.

Samples are rows (instrument_id, minute, second, side, price, qty) of the
levels held at valid seconds, minute in minutes since the epoch; seconds are
rows (instrument_id, minute, second) that were valid, with or without levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions import ids
from tickweave.operators import replay
from tickweave.schemas import DEPTH, SIDES, minute_columns

KEY = ["instrument_id", "minute"]
INT = "int"


def anchored(seconds: DataFrame) -> DataFrame:
    """Minutes whose second 0 is valid, with their bitmap; others are not kept."""
    per = seconds.groupBy(*KEY).agg(ids.bitmap(F.col("second")).alias("valid_bitmap"))
    return per.where(ids.is_set(F.col("valid_bitmap"), F.lit(0)))


def rank_levels(samples: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The best levels of each side: bids from the highest price, asks from the lowest."""
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    order = Window.partitionBy(*KEY, "second", "side").orderBy(best)
    return samples.where("qty > 0").withColumn("level", F.row_number().over(order)).where(F.col("level") <= depth)


def next_valid(second: Column, bitmap: Column) -> Column:
    """The next second after one whose bit is set, null if there is none: zeros below the lowest bit of what is left are counted."""
    rest = F.call_function("shiftright", bitmap, second + 1)
    lowest = rest.bitwiseAND(-rest)
    return F.when(rest != 0, second + 1 + F.bit_count(lowest - 1).cast(INT))


def _written(samples: DataFrame, seconds: DataFrame, depth: int | None) -> DataFrame:
    """Rows (key, valid_bitmap, second, side, price, qty) of an anchored minute's book at second 0 and of what differs from then on.

    Each level is put down as what its second has and as what the next valid
    second had before, and the two are met by one aggregate: no self-join, and
    the first second after a gap is compared with the last valid one.  Samples
    are dealt by minute once, which serves all that follows.
    """
    dealt = samples.repartition(*KEY)
    top = dealt if depth is None else rank_levels(dealt, depth)
    return _differences(top.join(anchored(seconds), KEY).where(ids.is_set(F.col("valid_bitmap"), F.col("second"))))


def _differences(held: DataFrame) -> DataFrame:
    """``_written`` from the levels of anchored minutes' valid seconds, each with its minute's bitmap."""
    kind = held.schema["qty"].dataType
    none = F.lit(None).cast(kind)
    both = held.select(
        *KEY, "valid_bitmap", "side", "price",
        F.explode(F.array(
            F.struct(F.col("second").cast(INT).alias("second"), F.col("qty").alias("now"), none.alias("was")),
            F.struct(next_valid(F.col("second").cast(INT), F.col("valid_bitmap")).alias("second"), none.alias("now"), F.col("qty").alias("was")),
        )).alias("e"),
    ).where("e.second is not null")
    met = both.groupBy(*KEY, "valid_bitmap", F.col("e.second").alias("second"), "side", "price").agg(F.max("e.now").alias("now"), F.max("e.was").alias("was"))
    return met.where(~F.col("now").eqNullSafe(F.col("was"))).select(*KEY, "valid_bitmap", "second", "side", "price", F.coalesce("now", F.lit(0)).cast(kind).alias("qty"))


def changes(samples: DataFrame, seconds: DataFrame) -> DataFrame:
    """Rows (key, second, side, price, qty) that differ from the last valid second; 0 for a price that went."""
    return _written(samples, seconds, None).where("second > 0").drop("valid_bitmap")


def _arrays(side: str, prices: str, qtys: str) -> list[Column]:
    """One side's rows as two arrays, bids from the highest price and asks from the lowest."""
    pairs = F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("price", "qty"))), asc=side == "ask")
    return [F.transform(pairs, lambda x: x["price"]).alias(prices), F.transform(pairs, lambda x: x["qty"]).alias(qtys)]


def whole_minutes(samples: DataFrame, seconds: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Minutes with their deltas, in one row each: what is stored, and an array of deltas by second; from samples that are ranked already or not."""
    found = _by_minute(_written(samples.drop("level"), seconds, depth), KEY)
    return _rows_of_minutes(anchored(seconds).join(found, KEY, "left"))


def minutes_of_books(seconds: DataFrame, kind: str) -> DataFrame:
    """``whole_minutes`` of seconds that come with their book, both sides' arrays of prices and quantities, which neither lack.

    The seconds may be dear to make, so they are read once: a minute's are put
    together with its bitmap and dealt out again, and nothing is joined.
    """
    book = [F.col(f"{s}_{n}") for s in SIDES for n in ("prices", "qtys")]
    per = seconds.groupBy(*KEY).agg(ids.bitmap(F.col("second")).alias("valid_bitmap"), F.collect_list(F.struct("second", *book)).alias("books"))
    each = per.where(ids.is_set(F.col("valid_bitmap"), F.lit(0))).select(*KEY, "valid_bitmap", F.inline("books"))
    held = each.select(*KEY, "valid_bitmap", "second", F.inline(replay.levels("prices", "qtys"))).withColumn("qty", F.col("qty").cast(kind))
    return _rows_of_minutes(_by_minute(_differences(held), [*KEY, "valid_bitmap"]))


def _by_minute(written: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, _anchor, deltas) of what was written in each minute."""
    names = [f"{s}_{n}" for s in SIDES for n in ("prices", "qtys")]
    each = written.groupBy(*keys, "second").agg(*[c for s in SIDES for c in _arrays(s, f"{s}_prices", f"{s}_qtys")])
    delta = F.struct(F.col("second").alias("second_offset"), *[F.col(n).alias(n.replace("_", "_change_", 1)) for n in names])
    return each.groupBy(*keys).agg(
        F.first(F.when(F.col("second") == 0, F.struct(*names)), ignorenulls=True).alias("_anchor"),
        F.sort_array(F.collect_list(F.when(F.col("second") > 0, delta))).alias("deltas"),
    )


def _rows_of_minutes(found: DataFrame) -> DataFrame:
    """Minutes as they are stored, with their deltas, from what each has; nothing where it has nothing."""
    names = [f"{s}_{n}" for s in SIDES for n in ("prices", "qtys")]
    anchor = {f.name: f.dataType for f in found.schema["_anchor"].dataType}
    key = F.shiftleft(F.col("minute"), 32).bitwiseOR(F.col("instrument_id"))
    none = lambda c: F.array().cast(anchor[c])
    return found.select(
        key.alias("id"), "instrument_id", F.timestamp_seconds(F.col("minute") * 60).alias("minute_time"), "valid_bitmap",
        *[F.coalesce(F.col("_anchor")[n], none(n)).alias(n) for n in names], F.coalesce("deltas", F.array().cast(found.schema["deltas"].dataType)).alias("deltas"),
    )


def split(whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(minutes, deltas) as they are stored."""
    return whole.drop("deltas"), whole.select(F.col("id").alias("minute_id"), F.inline("deltas"))


def encode(samples: DataFrame, seconds: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(minutes, deltas) as they are stored, from samples that are ranked already or not."""
    return split(whole_minutes(samples, seconds, depth))


def widen(minutes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The wide minute: levels as columns, absent ones 0, which stand last."""
    out = [F.col(c) for c in minute_columns()[:4]]
    for name in minute_columns()[4:]:
        side, kind, number = name.split("_")
        if int(number) <= depth:
            out.append(F.coalesce(F.get(f"{side}_{'prices' if kind == 'price' else 'qtys'}", F.lit(int(number) - 1)), F.lit(0)).alias(name))
    return minutes.select(*out)


def narrow(wide: DataFrame) -> DataFrame:
    """Arrays from the wide minute; zeros are dropped from the end, and one that isn't last is an error."""
    columns = []
    for side in SIDES:
        levels = F.array(*[F.struct(F.col(f"{side}_price_{n:02d}").alias("p"), F.col(f"{side}_qty_{n:02d}").alias("q")) for n in range(1, DEPTH + 1)])
        full = F.filter(levels, lambda x: (x["p"] != 0) | (x["q"] != 0))
        whole = F.exists(full, lambda x: (x["p"] <= 0) | (x["q"] <= 0)) | ~F.slice(levels, 1, DEPTH).eqNullSafe(F.concat(full, F.slice(levels, F.size(full) + 1, DEPTH)))
        checked = F.when(whole, F.raise_error(F.lit("padding within a side")).cast("array<struct<p:bigint,q:decimal(20,0)>>")).otherwise(full)
        columns += [F.transform(checked, lambda x: x["p"]).alias(f"{side}_prices"), F.transform(checked, lambda x: x["q"]).alias(f"{side}_qtys")]
    return wide.select(*minute_columns()[:4], *columns)


def sample_grid(states: DataFrame, until: Column | None = None) -> DataFrame:
    """Book states carried to whole seconds: rows (instrument_id, second_time, ...) of the last state at or before each second.

    ``states`` has an interval [from_time, to_time) for each state, to_time null
    for the last.  A state is repeated for the seconds it spans, so the cost is
    that of the samples and nothing is joined.
    """
    start = F.ceil(F.unix_micros("from_time") / 1_000_000).cast("long")
    end = F.ceil(F.unix_micros(F.coalesce(F.col("to_time"), until if until is not None else F.col("from_time"))) / 1_000_000).cast("long")
    seconds = F.when(end > start, F.sequence(start, F.greatest(end - 1, start)))
    return states.withColumn("_s", F.explode(seconds)).withColumn("second_time", F.timestamp_seconds("_s")).drop("_s", "from_time", "to_time")
