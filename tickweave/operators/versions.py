"""The current row of each key in tables that only grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQ = "_ingest_seq"


def current(df: DataFrame, keys: list[str], seq: str = SEQ, version: str | None = None) -> DataFrame:
    """The row of each key with the highest version, of equal ones the last inserted.

    An aggregate, so tasks combine their own rows before the shuffle; filters
    on key columns go through it to the scan.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.col(seq) if version is None else F.struct(F.col(version), F.col(seq))
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(df.columns)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
