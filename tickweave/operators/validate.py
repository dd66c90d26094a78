"""Validation: each row gets the codes of the rules that it breaks, and none is dropped unseen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import ids
from tickweave.schemas import DEFINITION, DEPTH

VIOLATIONS = "violations"


def codes(**rules: Column) -> Column:
    """Names of the rules whose condition is true; a condition that is null counts as broken."""
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules.items()]))


def split(df: DataFrame, violations: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows in quarantine with their codes)."""
    marked = df.withColumn(VIOLATIONS, violations)
    return marked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), marked.where(F.size(VIOLATIONS) > 0)


def _exact(c: str) -> Column:
    return (F.col(c) != "") & (F.trim(c) == F.col(c))


def instrument(with_id: bool = True) -> Column:
    """Broken rules of a definition; spot has no settlement or expiry and multiplier 1, only delivery expires."""
    kind, spot = F.col("market_type"), F.col("market_type") == "spot"
    rules = {f"{c}_text": ~_exact(c) for c in ("exchange", "exchange_symbol", "base_asset", "quote_asset")}
    rules["market_type"] = ~kind.isin("spot", "perpetual", "delivery")
    rules |= {c: ~(F.col(c) > 0) for c in ("contract_multiplier", "price_tick_size", "quantity_step_size")}
    known = F.coalesce(spot, F.lit(False))
    rules["settle_asset"] = F.when(known, F.col("settle_asset").isNotNull()).otherwise(~F.coalesce(_exact("settle_asset"), F.lit(False)))
    rules["spot_multiplier"] = known & ~F.coalesce(F.col("contract_multiplier") == 1, F.lit(False))
    delivery = F.coalesce(kind == "delivery", F.lit(False))
    rules["expiry_time"] = F.when(delivery, F.col("expiry_time").isNull()).otherwise(F.col("expiry_time").isNotNull())
    if with_id:
        rules = {"instrument_id": ~F.col("instrument_id").between(1, ids.MAX_INSTRUMENT)} | rules
    return codes(**rules)


def same_definition(a: DataFrame, b: DataFrame) -> Column:
    """Equal in all but the id; an absent settlement or expiry equals another."""
    out = F.lit(True)
    for c in DEFINITION:
        out = out & a[c].eqNullSafe(b[c])
    return out


def _in_order(prices: Column, descending: bool) -> Column:
    """Strictly one way; sides with fewer than two levels are in order (a sequence from 1 to 0 would run down)."""
    ok = lambda i: F.element_at(prices, i) > F.element_at(prices, i + 1) if descending else F.element_at(prices, i) < F.element_at(prices, i + 1)
    return F.when(F.size(prices) < 2, F.lit(True)).otherwise(F.forall(F.sequence(F.lit(1), F.greatest(F.size(prices) - 1, F.lit(1))), ok))


def snapshot(depth: int = DEPTH, prefix: tuple[str, str] = ("bid", "ask")) -> Column:
    """Broken rules of a book with columns bid_prices, bid_qtys, ask_prices and ask_qtys."""
    rules: dict[str, Column] = {}
    for side, down in zip(prefix, (True, False), strict=True):
        prices, qtys = F.col(f"{side}_prices"), F.col(f"{side}_qtys")
        rules[f"{side}_depth"] = ~F.size(prices).between(1, depth)
        rules[f"{side}_lengths"] = F.size(prices) != F.size(qtys)
        rules[f"{side}_positive"] = F.exists(prices, lambda x: x <= 0) | F.exists(qtys, lambda x: x <= 0)
        rules[f"{side}_order"] = ~_in_order(prices, down)
    rules["crossed"] = F.when((F.size(f"{prefix[0]}_prices") > 0) & (F.size(f"{prefix[1]}_prices") > 0), F.get(f"{prefix[0]}_prices", F.lit(0)) >= F.get(f"{prefix[1]}_prices", F.lit(0))).otherwise(F.lit(False))
    return codes(**rules)


def changes(prices: Column) -> Column:
    """Broken rules of one side's changes: prices above 0, each once."""
    return codes(positive=F.exists(prices, lambda x: x <= 0), once=F.size(F.array_distinct(prices)) != F.size(prices))


def delta() -> Column:
    """Broken rules of a stored delta by itself."""
    rules = {"second_offset": ~F.col("second_offset").between(1, 59)}
    for side in ("bid", "ask"):
        prices, qtys = F.col(f"{side}_change_prices"), F.col(f"{side}_change_qtys")
        rules[f"{side}_lengths"] = F.size(prices) != F.size(qtys)
        rules[f"{side}_prices"] = F.exists(prices, lambda x: x <= 0) | (F.size(F.array_distinct(prices)) != F.size(prices))
        rules[f"{side}_qtys"] = F.exists(qtys, lambda x: x < 0)
    return codes(**rules)


def minute() -> Column:
    """Broken rules of a stored minute by itself: its id, a valid second 0, no bit beyond 59, and its anchor book."""
    return F.array_union(
        codes(
            id=~F.col("id").eqNullSafe(ids.minute_id(F.col("instrument_id"), F.col("minute_time"))),
            minute_time=F.date_trunc("minute", "minute_time") != F.col("minute_time"),
            anchor=~ids.is_set(F.col("valid_bitmap"), F.lit(0)),
            bitmap=~F.col("valid_bitmap").between(0, ids.FULL_MINUTE),
        ),
        snapshot(),
    )


def orphan_deltas(minutes: DataFrame, deltas: DataFrame) -> DataFrame:
    """Deltas of no minute, or at a second that their minute doesn't have as valid."""
    held = minutes.select(F.col("id").alias("minute_id"), "valid_bitmap")
    joined = deltas.join(held, "minute_id", "left")
    return joined.where(F.col("valid_bitmap").isNull() | ~ids.is_set(F.col("valid_bitmap"), F.col("second_offset"))).select(deltas.columns)


def funding_rate() -> Column:
    return codes(
        instrument_id=~F.col("instrument_id").between(1, ids.MAX_INSTRUMENT), hour_time=~ids.is_whole_hour(F.col("hour_time")),
        funding_time=~ids.is_whole_milli(F.col("funding_time")), rate=F.col("rate").isNull(), is_actual=F.col("is_actual").isNull(),
    )


def funding_estimate() -> Column:
    return codes(
        instrument_id=~F.col("instrument_id").between(1, ids.MAX_INSTRUMENT), funding_time=~ids.is_whole_milli(F.col("funding_time")),
        source_time=F.col("source_time").isNull(), rate=F.col("rate").isNull(),
    )


def answers_task(rate: DataFrame, task: DataFrame) -> Column:
    """Whether a confirmed rate is the one that a task asked for."""
    return (
        rate["is_actual"]
        & (rate["instrument_id"] == task["instrument_id"])
        & (rate["funding_time"] == task["funding_time"])
        & (rate["hour_time"] == F.date_trunc("hour", task["funding_time"]))
    )
