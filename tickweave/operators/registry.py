"""Instruments: ids, lookup by feed symbol, ordered selection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.ids import MAX_INSTRUMENT
from tickweave.operators.ordering import running_count
from tickweave.schemas import DEFINITION


def register(
    existing: DataFrame, incoming: DataFrame, fields: list[str] = DEFINITION, id_column: str = "instrument_id", pos: str = "pos", rules: Column | None = None
) -> DataFrame:
    """Ids for definitions in the order of ``pos``: that of an equal definition, or else the next free one.

    Equal definitions share an id, also within the input.  A definition that
    changed is another one and gets a new id.  Rows (pos, id, is_new, fields).
    New definitions are numbered without gaps by counts of ranges of ``pos``, a
    whole number, so no task sorts them all.  ``rules`` are the codes of the
    rules that a row breaks (validate.instrument): one row that breaks any
    refuses the whole batch when it is read.
    """
    known = existing.groupBy(*[F.col(c).alias(f"_k_{c}") for c in fields]).agg(F.min(id_column).alias("_known"))
    first = incoming.groupBy(*[F.col(c).alias(f"_d_{c}") for c in fields]).agg(F.min(pos).alias("_first"))
    same = lambda left, right: reduce(and_, (F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in fields))
    joined = first.join(known, same("_d_", "_k_"), "left").select(*[f"_d_{c}" for c in fields], "_first", "_known")
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("_top"))
    fresh = running_count(joined.where("_known is null"), [], "_first", F.lit(True), "_n")
    ids = joined.where("_known is not null").withColumn("_n", F.lit(None).cast("long")).unionByName(fresh).crossJoin(F.broadcast(top))
    numbered = ids.select(*[f"_d_{c}" for c in fields], F.coalesce("_known", F.col("_top") + F.col("_n")).alias("_id"), F.col("_known").isNull().alias("is_new"))
    checked = F.when(F.col("_id") <= MAX_INSTRUMENT, F.col("_id")).otherwise(F.raise_error(F.lit("no instrument id is left")).cast("long"))
    if rules is not None:
        broken = incoming.select(pos, rules.alias("_rules")).where(F.size("_rules") > 0).agg(F.min_by(F.concat_ws(",", "_rules"), pos).alias("_broken"), F.count(F.lit(1)).alias("_bad"))
        numbered = numbered.crossJoin(F.broadcast(broken))  # one row
        refused = F.raise_error(F.concat(F.col("_bad").cast("string"), F.lit(" rows break rules, the first one: "), F.col("_broken"))).cast("long")
        checked = F.when(F.col("_bad") == 0, checked).otherwise(refused)
    return incoming.select(pos, *fields).join(numbered, same("", "_d_")).select(pos, checked.cast("long").alias(id_column), "is_new", *fields)


def select_in_order(available: DataFrame, requested: list[str], column: str = "exchange_symbol") -> DataFrame:
    """The requested rows in the order asked for, with their place in ``pos``.

    Names are exact and case counts; one that is asked for twice or isn't
    available, or that two rows have, is an error.
    """
    if len(set(requested)) != len(requested):
        raise ValueError("a symbol is asked for twice")
    spark = available.sparkSession
    asked = spark.createDataFrame(list(enumerate(requested)), "pos int, _name string")
    joined = available.join(F.broadcast(asked), available[column] == asked["_name"])  # as many as the caller has named
    counts = {x["_name"]: x["n"] for x in joined.groupBy("_name").agg(F.count(column).alias("n")).collect()}
    wrong = sorted(x for x in requested if counts.get(x, 0) != 1)
    if wrong:
        raise LookupError(f"not available once: {wrong}")
    return joined.select("pos", *available.columns).orderBy("pos")


def lookup(feed: DataFrame, instruments: DataFrame, symbol: str, column: str = "exchange_symbol") -> tuple[DataFrame, DataFrame]:
    """(feed rows with their instrument, feed rows of symbols that no instrument has)."""
    dim = instruments.select(F.col(column).alias(symbol), "instrument_id")
    return feed.join(dim, symbol), feed.join(dim, symbol, "left_anti")


def route_backfill(pending: DataFrame, instruments: DataFrame, exchanges: list[str]) -> DataFrame:
    """Pending confirmations of configured perpetuals with their exchange; others are left out.

    A configured exchange without a worker is an error when the row is read.
    """
    perps = instruments.where("market_type = 'perpetual'").select("instrument_id", "exchange", "exchange_symbol")
    routed = pending.join(perps, "instrument_id")
    missing = F.raise_error(F.concat(F.lit("no worker for "), F.col("exchange"))).cast("string")
    return routed.withColumn("exchange", F.when(F.col("exchange").isin(exchanges), F.col("exchange")).otherwise(missing))
