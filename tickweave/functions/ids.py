"""Minute ids, validity bitmaps and UTC truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_INSTRUMENT = 2**32 - 1
#: Minutes since the epoch under which the id is a positive long.
MAX_MINUTE = 2**31 - 1
SECONDS = 60
FULL_MINUTE = 2**SECONDS - 1


def minute_id(instrument: Column, time: Column) -> Column:
    """(minutes since the epoch << 32) | instrument; null outside 1..2**32-1 or the positive longs."""
    minute = F.floor(F.unix_seconds(time) / 60).cast("long")
    good = instrument.between(1, MAX_INSTRUMENT) & minute.between(0, MAX_MINUTE)
    return F.when(good, F.shiftleft(minute, 32).bitwiseOR(instrument.cast("long")))


def minute_time(minute_id: Column) -> Column:
    return F.timestamp_seconds(F.shiftright(minute_id, 32) * 60)


def instrument_of(minute_id: Column) -> Column:
    return minute_id.bitwiseAND(F.lit(MAX_INSTRUMENT))


def bit(second: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), second.cast("int"))


def is_set(bitmap: Column, second: Column) -> Column:
    return F.coalesce(bitmap.bitwiseAND(bit(second)) != 0, F.lit(False))


def bitmap(second: Column) -> Column:
    """Aggregate: the bits of all seconds; 0 over no rows."""
    return F.coalesce(F.bit_or(bit(second)), F.lit(0).cast("long"))


def is_whole_hour(time: Column) -> Column:
    return F.date_trunc("hour", time) == time


def is_whole_milli(time: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(time)) == time
