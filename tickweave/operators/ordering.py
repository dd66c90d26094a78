"""Running counts and dense numbers over long sequences, none of which one task has to hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Values of the order that one range spans.
WIDTH = 1 << 16


def running_count(rows: DataFrame, keys: list[str], order: str, flag: Column, name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``: for each key, the rows up to this one in ``order`` (an integer column) for which the flag holds.

    Keys are never null.  The order is cut into ranges of ``width`` values.  The ranges' counts are
    summed up over a key, which are few rows; within a range the count runs on
    its own.  So a key's rows are dealt to as many groups as it has ranges.
    """
    at, hit, before = (f"__{name}_{x}__" for x in ("range", "hit", "before"))
    marked = rows.withColumn(at, F.floor(F.col(order) / width).cast("long")).withColumn(hit, F.coalesce(flag, F.lit(False)).cast("long"))
    ahead = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(*keys, at).agg(F.sum(hit).alias(before)).withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    within = Window.partitionBy(*keys, at).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumn(name, F.sum(hit).over(within))
    found = counted.join(sums, [*keys, at], "left")
    return found.select(*(F.col(f"`{c}`") for c in rows.columns if c != name), (F.col(name) + F.col(before)).alias(name))


def previous(rows: DataFrame, keys: list[str], order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``: the value of the row before in ``order`` (an integer column) of the same key, null for the first.

    Cut into ranges as in ``running_count``: only a range's first row needs
    what was last before it, which the ranges' last values tell.
    """
    return _beside(rows, keys, order, value, name, width, F.lag, F.max_by)


def following(rows: DataFrame, keys: list[str], order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``: the value of the row after in ``order``, null for the last; else as ``previous``."""
    return _beside(rows, keys, order, value, name, width, F.lead, F.min_by)


def _beside(rows: DataFrame, keys: list[str], order: str, value: str, name: str, width: int, step: Callable[[Column | str], Column], nearest: Callable[[str, str], Column]) -> DataFrame:
    at, edge, beyond = (f"__{name}_{x}__" for x in ("range", "edge", "beyond"))
    marked = rows.withColumn(at, F.floor(F.col(order) / width).cast("long"))
    ranges = marked.groupBy(*keys, at).agg(nearest(value, order).alias(beyond))
    ranges = ranges.withColumn(beyond, step(beyond).over(Window.partitionBy(*keys).orderBy(at)))
    within = Window.partitionBy(*keys, at).orderBy(order)
    seen = marked.withColumn(edge, step(F.lit(True)).over(within).isNull()).withColumn(name, step(value).over(within))
    found = seen.join(ranges, [*keys, at], "left")
    return found.select(*(F.col(f"`{c}`") for c in rows.columns if c != name), F.when(F.col(edge), F.col(beyond)).otherwise(F.col(name)).alias(name))
