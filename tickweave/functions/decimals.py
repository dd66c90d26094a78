"""Exact decimals: strict text, whole ticks and lots, and back again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Optional minus, digits with at most one dot, at least one digit; no plus, exponent or blanks.
STRICT = r"^-?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
MAX_TICK = 2**63 - 1
MAX_LOT = 2**64 - 1
SCALE = 18
WIDE = f"decimal(38,{SCALE})"


def is_strict(raw: Column) -> Column:
    """Whether text is a strict decimal; null isn't."""
    return F.coalesce(raw.rlike(STRICT), F.lit(False))


def written_scale(raw: Column) -> Column:
    return F.length(F.regexp_extract(raw, r"[.]([0-9]*)$", 1))


def strict(raw: Column) -> Column:
    """decimal(38,18) of strict text; null for other text, more than 18 places or 20 whole digits.

    The places are counted in the text, as a cast would round them away.
    """
    return F.when(is_strict(raw) & (written_scale(raw) <= SCALE), F.rtrim(raw, F.lit(".")).try_cast(WIDE))


def positive(raw: Column) -> Column:
    value = strict(raw)
    return F.when(value > 0, value)


def _digits(value: Column, within: str) -> Column:
    """A value of a type of up to 18 digits as the long of its digits: one multiplication, and all that follows is on longs."""
    scale = int(within.rstrip(")").split(",")[1])
    return (value.try_cast(within) * F.lit(10**scale).cast("decimal(18,0)" if scale < 18 else "decimal(19,0)")).cast("long")


def _quotient(value: Column, step: Column, within: str, positive: bool) -> Column:
    """value / step where step divides a value of 0 (or a step) and more, else null; the remainder decides, exactly.

    In a type of up to 18 digits both become longs of the same scale first.  In
    wider ones ``div`` would wrap beyond 2**63, so they are divided by ``/``.
    """
    narrow = int(within.split("(")[1].split(",")[0]) <= 18
    value, step = (_digits(x, within) if narrow else x.try_cast(within) for x in (value, step))
    good = (step > 0) & (value >= (step if positive else F.lit(0).cast("long" if narrow else within))) & (value % step == 0)
    return F.when(good, F.call_function("div", value, step) if narrow else value / step)


def price_tick(value: Column, step: Column, within: str = WIDE) -> Column:
    """Whole ticks from 1 to 2**63-1 as a long, else null: nothing is rounded.

    ``within`` is a decimal type that holds both price and step, if that is
    known; what it doesn't hold is null.
    """
    return _quotient(value, step, within, True).try_cast("long")


def quantity_lot(value: Column, step: Column, within: str = WIDE) -> Column:
    """Whole lots from 0 to 2**64-1 as decimal(20,0), else null; ``within`` as for prices."""
    lots = _quotient(value, step, within, False)
    if within != WIDE:
        return lots.cast("decimal(20,0)")
    beyond = F.lit(str(MAX_LOT + 1)).cast("decimal(26,0)")
    return F.nullif(F.least(lots.try_cast("decimal(26,0)"), beyond), beyond).cast("decimal(20,0)")


def price(tick: Column, step: Column) -> Column:
    return tick.cast("decimal(19,0)") * step


def quantity(lot: Column, step: Column, multiplier: Column | None = None) -> Column:
    """Units of the contract, or of the base asset where a contract multiplier is given."""
    units = lot.cast("decimal(20,0)") * step
    return units if multiplier is None else units * multiplier
